"""Licence scan on real licence files and on headers in comments of longer files."""

import re

import pytest

from labelkiln.llm import licences
from labelkiln.llm.licence_texts import HEADERS, TEXTS

CODE = "\n".join(f"def step_{n}(left, right):\n    return left * {n} + right  # next\n" for n in range(300))
PROSE = ["You may use this software at any person's own risk, and copies of the notice are free of charge for the public.",
         "The license of the driver was revoked; all the rights of the library were reserved for members.",
         "Permission to enter the gardens is granted to anyone, subject to the conditions above."]


def commented(text: str, style: str) -> str:
    lines = text.strip("\n").split("\n")
    if style == "/*":
        return "/*\n" + "\n".join(" * " + x for x in lines) + "\n */"
    return "\n".join(f"{style} {x}".rstrip() for x in lines)


@pytest.fixture(scope="module")
def found(spark):
    rows = []
    for n, (name, text) in enumerate(HEADERS):
        for k, style in enumerate(("/*", "#", "//")):
            head = commented("Copyright 2019 The Example Authors\n\n" + text, style)
            rows.append((f"src/{n}/{k}/x.py", f"{head}\n{CODE}", name))
    for n, (name, text) in enumerate(TEXTS):
        rows.append((f"dir{n}/LICENSE", f"{text}", name))
        rows.append((f"top{n}/LICENSE", f"Copyright (c) 2021 Jane Doe and others\n\n{text}", name))
        rows.append((f"in{n}/notes", f"{CODE}\n\n{text}\n\n{CODE}", name))
    rows += [(f"prose/{n}", p, None) for n, p in enumerate(PROSE)] + [("code/x.py", CODE, None), ("dir0/sub/deep/x.py", CODE, "0BSD")]
    files = spark.createDataFrame([r[:2] for r in rows], "path string, text string")
    got = {r["path"]: r for r in licences.scan(files).collect()}
    assert len(got) == len(rows)
    return {p: (want, got[p]["license"], got[p]["origin"], got[p]["from_dir"]) for p, _, want in rows}


@pytest.mark.parametrize("place", ["src", "dir", "top", "in"])
def test_texts_and_headers_are_found(found, place):
    wrong = {p: v for p, v in found.items() if re.match(place + r"[\d/]", p) and not p.endswith("deep/x.py") and (v[0] != v[1] or v[2] != "own")}
    assert not wrong


def test_prose_and_code_have_none(found):
    assert {v[1] for p, v in found.items() if p.startswith(("prose", "code"))} == {None}


def test_licence_file_passes_down(found):
    assert found["dir0/sub/deep/x.py"] == ("0BSD", "0BSD", "inherited", "dir0")


def test_passing_over_is_exact(spark):
    """With every unit scored, the same licences come out."""
    texts = [("a", commented(HEADERS[1][1], "#") + "\n" + CODE), ("b", TEXTS[16][1]), ("c", " ".join(PROSE)), ("d", TEXTS[4][1][:300]),
             ("e", "released under mit"), ("f", "license\nMIT\n\nLicense, released"), ("g", "")]
    files = spark.createDataFrame(texts, "path string, text string")
    templates = spark.createDataFrame(licences.TEMPLATES, "license string, text string")
    want = sorted(map(tuple, licences.own_licences(files, templates).collect()), key=str)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(licences, "reachable", lambda low, needed: low.isNotNull())
        assert sorted(map(tuple, licences.own_licences(files, templates).collect()), key=str) == want
