"""Term families: one category per reaction term (organ, hybrid, symptom), and the older label dictionary.

FIXED VALUES: names, order and regular expressions must equal the published
dictionaries for categories to come out the same; they are kept as plain
text in their original order.  All are matched case-insensitively.
"""

from . import RuleSet

# ---- fixed values ------------------------------------------------------------
#: Organ classes, tried in this order.
ORGAN = {
    "gastrointestinal":
        r"\b(diarrh\w*|nause\w*|vomit\w*|abdom\w*|constipat\w*|colitis|gastr\w*|pancreat\w*|ileus|dyspeps\w*|"
        r"gastro\w*|stomatit\w*|oesophag\w*|esophag\w*)\b",
    "cardiovascular":
        r"\b(cardiac\w*|heart\w*|myocard\w*|infarct\w*|arrhyth\w*|tachycard\w*|bradycard\w*|hypertension|"
        r"hypotension|atrial\w*|ventric\w*|thromboembol\w*|embol\w*|stroke)\b",
    "neurological":
        r"\b(headache\w*|dizz\w*|seiz\w*|convuls\w*|neurop\w*|syncope\w*|migraine\w*|tremor\w*|ataxia\w*|"
        r"vertigo\w*|paresthes\w*)\b",
    "dermatologic": r"\b(rash\w*|prurit\w*|urticar\w*|dermatit\w*|eczema\w*|psoriasis\w*|alopec\w*|erythema\w*|skin)\b",
    "hematologic":
        r"\b(anaemi\w*|thrombocyt\w*|neutrop\w*|leukopen\w*|lymphopen\w*|pancytopen\w*|coagul\w*|"
        r"haemorrhag\w*|hemorrhag\w*)\b",
    "hepatic": r"\b(hepatic\w*|liver\w*|hepatit\w*|bilirubin\w*|jaundice\w*|cholestat\w*|transamin\w*|alt\b|ast\b)\b",
    "renal": r"\b(renal\w*|kidney\w*|nephr\w*|creatinin\w*|acute kidney\w*|glomerul\w*)\b",
    "respiratory":
        r"\b(dyspn\w*|cough\w*|pneumon\w*|asthma\w*|bronch\w*|wheez\w*|pulmon\w*|rhinitis\w*|nasopharyng\w*|"
        r"respiratory)\b",
}

#: Classes that the hybrid family tries before the organ classes.
HYBRID_EXTRA = {
    "product_use_or_medication_error":
        r"\b(product\w*|dose omission|wrong dose|incorrect dose|medication error|device\w*|malfunction|"
        r"accidental exposure|overdose|underdose|administration|dispensing)\b",
    "lack_of_effect_or_off_label": r"\b(drug ineffective|lack of efficacy|off label|therapeutic response decreased|treatment failure)\b",
    "general_systemic": r"\b(fatigue|malaise|asthenia|pyrexia|fever|chills|pain|condition aggravated|discomfort)\b",
    "musculoskeletal_pain": r"\b(arthralgia|myalgia|back pain|musculoskeletal|joint pain|bone pain)\b",
    "infections": r"\b(infection|sepsis|pneumonia|covid|influenza|cellulitis)\b",
}

#: Symptom classes, tried in this order.
SYMPTOM = {
    "gastrointestinal":
        r"\b(diarrh\w*|nause\w*|vomit\w*|abdom\w*|constipat\w*|colitis|gastr\w*|pancreat\w*|ileus|dyspeps\w*|"
        r"stomatit\w*|oesophag\w*|esophag\w*)\b",
    "cardiovascular":
        r"\b(cardiac\w*|heart\w*|myocard\w*|infarct\w*|arrhyth\w*|tachycard\w*|bradycard\w*|hypertension|"
        r"hypotension|atrial\w*|ventric\w*|thromboembol\w*|embol\w*|stroke)\b",
    "neurological":
        r"\b(headache\w*|dizz\w*|seiz\w*|convuls\w*|neurop\w*|syncope\w*|migraine\w*|tremor\w*|ataxia\w*|"
        r"vertigo\w*|paresthes\w*|somnolence)\b",
    "dermatologic": r"\b(rash\w*|prurit\w*|urticar\w*|dermatit\w*|eczema\w*|psoriasis\w*|alopec\w*|erythema\w*|skin)\b",
    "hematologic":
        r"\b(anaemi\w*|thrombocyt\w*|neutrop\w*|leukopen\w*|lymphopen\w*|pancytopen\w*|coagul\w*|"
        r"haemorrhag\w*|hemorrhag\w*)\b",
    "hepatic": r"\b(hepatic\w*|liver\w*|hepatit\w*|bilirubin\w*|jaundice\w*|cholestat\w*|transamin\w*|alt\b|ast\b)\b",
    "renal": r"\b(renal\w*|kidney\w*|nephr\w*|creatinin\w*|acute kidney\w*|glomerul\w*)\b",
    "respiratory":
        r"\b(dyspn\w*|cough\w*|pneumon\w*|asthma\w*|bronch\w*|wheez\w*|pulmon\w*|rhinitis\w*|nasopharyng\w*|"
        r"respiratory)\b",
    "general_systemic": r"\b(fatigue|malaise|asthenia|pyrexia|fever|chills|illness)\b",
    "musculoskeletal_pain": r"\b(arthralgia|myalgia|back pain|pain in extremity|musculoskeletal|joint pain|bone pain)\b",
    "infections": r"\b(infection|sepsis|pneumonia|influenza|covid|cellulitis)\b",
    "psychiatric": r"\b(anxiety|depression|insomnia|agitation|panic)\b",
    "metabolic_weight": r"\b(weight increased|weight decreased|decreased appetite|increased appetite)\b",
    "injury_fall": r"\b(fall|injury|fracture|contusion)\b",
    "injection_site": r"\b(injection site|injection-site)\b",
}

#: The first label dictionary.
V1_LABELS = {
    "gastrointestinal":
        r"\b(?:diarrh\w*|nausea|vomit\w*|abdominal|constipat\w*|dyspeps\w*|reflux|flatulence|colitis|"
        r"pancreat\w*|haematochezia|gastrointestinal haemorrhage|rectal haemorrhage|stomatitis|dysphagia)\b",
    "cardiovascular":
        r"\b(?:hypertension|hypotension|palpitation\w*|tachycard\w*|atrial fibrillation|myocardial infarction|"
        r"thrombosis|pulmonary embolism|blood pressure increased|blood pressure decreased|"
        r"heart rate increased|cardiac failure)\b",
    "neurological":
        r"\b(?:headache|dizz\w*|seizure|tremor|confusional state|memory impairment|paraesthesia|hypoaesthesia|"
        r"migraine|syncope|loss of consciousness|vertigo|balance disorder|amnesia|brain fog)\b",
    "dermatologic":
        r"\b(?:rash\w*|prurit\w*|erythema|urticaria|eczema|psoriasis|alopecia|blister|acne|dry skin|"
        r"skin burning sensation|skin exfoliation)\b",
    "hematologic":
        r"\b(?:anaemi\w*|neutropen\w*|leukopen\w*|thrombocytopen\w*|pancytopen\w*|myelosuppression|"
        r"febrile neutropenia|haemorrhag\w*|hemorrhag\w*)\b",
    "hepatic":
        r"\b(?:hepatit\w*|jaundice|liver injury|drug-induced liver injury|hepatic function abnormal|"
        r"liver disorder|hepatic enzyme increased)\b",
    "renal": r"\b(?:acute kidney injury|renal impairment|renal failure|renal disorder|nephrolithiasis)\b",
    "respiratory":
        r"\b(?:dyspnoea|dyspnea|cough\w*|asthma|wheez\w*|bronchit\w*|sinusitis|rhinitis|nasopharyngitis|"
        r"upper respiratory tract infection|lower respiratory tract infection|respiratory tract infection|"
        r"interstitial lung disease|pleural effusion|oxygen saturation decreased|epistaxis)\b",
    "general_systemic":
        r"\b(?:fatigue|malaise|asthenia|pyrexia|fever|chills|feeling abnormal|illness|influenza like illness|"
        r"feeling hot|hot flush|flushing)\b",
    "pain_general": r"\b(?:\bpain\b|chest pain|chest discomfort|back pain|bone pain|pain in extremity|discomfort)\b",
    "musculoskeletal":
        r"\b(?:arthralgia|myalgia|muscle spasms|muscular weakness|arthritis\b|osteoarthritis|joint swelling|"
        r"musculoskeletal stiffness|arthropathy|fibromyalgia)\b",
    "edema_swelling": r"\b(?:peripheral swelling|oedema\b|edema\b|swelling\b|swelling face|fluid retention)\b",
    "infections":
        r"\b(?:pneumonia|covid-19|influenza\b|infection\b|sepsis|cellulitis|viral infection|herpes zoster|"
        r"septic shock)\b",
    "psychiatric":
        r"\b(?:anxiety|insomnia|depression|stress|agitation|hallucination|suicidal ideation|suicide attempt|"
        r"irritability|nervousness|emotional distress|depressed mood)\b",
    "urinary": r"\b(?:urinary tract infection|dysuria|cystitis|haematuria|hematuria|urinary retention)\b",
    "injection_site": r"\b(?:injection site|infusion site)\b",
}
# ---- end of fixed values -------------------------------------------------------


def _ci(labels: dict[str, str]) -> dict[str, str]:
    return {name: "(?i)" + pattern for name, pattern in labels.items()}


ORGAN9 = RuleSet(name="organ", labels=_ci(ORGAN), fallback="other")
HYBRID = RuleSet(name="hybrid", labels=_ci(HYBRID_EXTRA | ORGAN), fallback="other_rare")
SYMPTOMS = RuleSet(name="symptom", labels=_ci(SYMPTOM), fallback="other_symptom")
FAMILIES = [ORGAN9, HYBRID, SYMPTOMS]
