"""Analog rule set over part names (adjective + noun), used on the driver tables.

Part names combine one adjective {small, cold, large, blue, new, red,
old, hot} with one noun {rod, gizmo, plate, gear, anvil, widget, bolt,
ring}.  Eight labels pair words the way the adverse-event dictionary
groups reaction terms; one exact term and one regex are noise to drop.
"""

from . import RuleSet

PARTS = RuleSet(
    name="parts",
    labels={
        "fastener": r"(?i)\b(?:bolt|rod)\b",
        "rotary": r"(?i)\b(?:gear|ring)\b",
        "device": r"(?i)\b(?:gizmo|widget)\b",
        "sheet": r"(?i)\bplate\b",
        "thermal": r"(?i)\b(?:hot|cold)\b",
        "sized": r"(?i)\b(?:small|large)\b",
        "colored": r"(?i)\b(?:blue|red)\b",
        "aged": r"(?i)\b(?:new|old)\b",
    },
    drop_exact=("old widget",),
    drop_regex=r"(?i)\banvil\b",
    fallback="other",
)
