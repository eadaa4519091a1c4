"""Adverse-event reaction-term rule sets (v1 drop rules, v2 drop rules, v2 labels).

FIXED VALUES: the term sets and regular expressions below must equal the
published dictionaries for labels to come out the same; they are kept
as plain text, in their original order.  All regexes are matched
case-insensitively (the ``(?i)`` flag is added when compiling).
"""

from . import RuleSet
from .families import V1_LABELS

# ---- fixed values: v1 drop rules ------------------------------------------
V1_DROP_EXACT = (
    "Off label use",
    "Drug ineffective",
    "No adverse event",
    "Adverse event",
    "Adverse drug reaction",
)

V1_DROP_REGEX = (
    r"\b(?:"
    r"product|device|malfunction|breakage|leakage|defective|delivery system|needle issue|"
    r"dose omission|incorrect dose|wrong dose|extra dose|underdose|overdose|medication error|"
    r"inappropriate schedule|administration|dispensing|wrong technique|misuse|"
    r"product use issue|product use in unapproved indication|product storage error|"
    r"product quality issue|product availability issue|product complaint|"
    r"off label|drug ineffective|lack of efficacy|treatment failure|therapeutic response|"
    r"therapy non-responder|partial responder|effect less than expected|"
    r"treatment noncompliance|therapy interrupted|therapy cessation"
    r")\b"
)

# ---- fixed values: v2 drop rules ------------------------------------------
V2_DROP_EXACT = (
    "Death",
    "Hospitalisation",
    "Hospitalization",
    "Drug interaction",
    "Surgery",
    "Disease progression",
    "Malignant neoplasm progression",
    "Neoplasm malignant",
    "Condition aggravated",
    "Toxicity to various agents",
    "Drug effective for unapproved indication",
    "Exposure during pregnancy",
    "Maternal exposure during pregnancy",
    "Foetal exposure during pregnancy",
    "Exposure via skin contact",
    "Drug abuse",
    "Drug diversion",
    "Drug dependence",
    "Drug intolerance",
    "Ill-defined disorder",
    "Insurance issue",
    "Drug resistance",
    "Disease recurrence",
    "Autism spectrum disorder",
    "Breast cancer",
    "Meningioma",
    "Plasma cell myeloma",
    "Systemic lupus erythematosus",
)

V2_DROP_REGEX = (
    r"\b(?:"
    r"exposure\b|"
    r"drug interaction|"
    r"disease progression|"
    r"neoplasm progression|"
    r"neoplasm malignant|"
    r"surgery\b|"
    r"hospitalis(?:ation|ation)|"
    r"death\b|"
    r"condition aggravated|"
    r"toxicity to various agents|"
    r"drug effective for unapproved indication|"
    r"drug abuse|drug diversion|drug dependence|drug intolerance|ill-defined disorder|"
    r"insurance issue|drug resistance|disease recurrence|"
    r"autism spectrum disorder|breast cancer|meningioma|myeloma|plasma cell myeloma|systemic lupus erythematosus"
    r")\b"
)

# ---- fixed values: v2 label dictionary (21 labels, original order) ---------
V2_LABELS = {
    "gastrointestinal":
        r"\b(?:diarrh\w*|nausea|vomit\w*|abdominal|constipat\w*|dyspeps\w*|reflux|flatulence|colitis|pancreat\w*|"
        r"haematochezia|hem(at|a)ochezia|gastrointestinal haemorrhage|rectal haemorrhage|stomatitis|dysphagia|"
        r"crohn|ulcerative colitis|gastrointestinal disorder|intestinal obstruction)\b",
    "cardiovascular":
        r"\b(?:"
        r"hypertension|hypotension|palpitation\w*|tachycard\w*|bradycard\w*|atrial fibrillation|myocardial infarction|"
        r"thrombosis|pulmonary embolism|cardiac failure|arrhythmia|cardiac arrest|cardiac disorder|"
        r"blood pressure increased|blood pressure decreased|heart rate increased|heart rate decreased|"
        r"cardiac fibrillation|"
        r"blood pressure fluctuation|heart rate abnormal|intracardiac pressure increased"
        r")\b",
    "neurological":
        r"\b(?:headache|dizz\w*|seizure|tremor|confusional state|memory impairment|paraesthesia|hypoaesthesia|migraine|"
        r"syncope|loss of consciousness|vertigo|balance disorder|amnesia|brain fog|somnolence|sedation|neuropathy|dementia|"
        r"cerebrovascular accident|stroke)\b",
    "dermatologic":
        r"\b(?:rash\w*|prurit\w*|erythema|urticaria|eczema|psoriasis|alopecia|blister|acne|dry skin|skin burning sensation|"
        r"skin exfoliation|dermatitis|atopic|hidradenitis)\b",
    "hematologic":
        r"\b(?:anaemi\w*|neutropen\w*|leukopen\w*|thrombocytopen\w*|pancytopen\w*|myelosuppression|febrile neutropenia|"
        r"haemorrhag\w*|hemorrhag\w*|white blood cell count decreased|platelet count decreased)\b",
    "hepatic":
        r"\b(?:"
        r"hepatit\w*|jaundice|liver injury|drug-induced liver injury|hepatic function abnormal|liver disorder|"
        r"hepatic enzyme increased|hepatic cytolysis|"
        r"alanine aminotransferase increased|aspartate aminotransferase increased|"
        r"transaminases increased|liver enzymes increased|"
        r"hepatic enzyme abnormal|hepatic infection|"
        r"bilirubin increased|bilirubin conjugated increased"
        r")\b",
    "renal":
        r"\b(?:acute kidney injury|renal impairment|renal failure|renal disorder|nephrolithiasis)\b",
    "respiratory":
        r"\b(?:"
        r"dyspnoea|dyspnea|cough\w*|asthma|wheez\w*|bronchit\w*|sinusitis|rhinitis|nasopharyngitis|"
        r"upper respiratory tract infection|lower respiratory tract infection|respiratory tract infection|"
        r"interstitial lung disease|pleural effusion|oxygen saturation decreased|epistaxis|"
        r"oxygen saturation abnormal|lung disorder|increased bronchial secretion"
        r")\b",
    "general_systemic":
        r"\b(?:fatigue|malaise|asthenia|pyrexia|fever|chills|feeling abnormal|illness|influenza like illness|"
        r"feeling hot|hot flush|flushing|general physical health deterioration)\b",
    "pain_general":
        r"\b(?:\bpain\b|chest pain|chest discomfort|back pain|bone pain|pain in extremity|discomfort)\b",
    "musculoskeletal":
        r"\b(?:arthralgia|myalgia|muscle spasms|muscular weakness|arthritis\b|osteoarthritis|joint swelling|"
        r"musculoskeletal stiffness|arthropathy|fibromyalgia|rhabdomyolysis)\b",
    "edema_swelling":
        r"\b(?:peripheral swelling|oedema\b|edema\b|swelling\b|swelling face|fluid retention|angioedema)\b",
    "infections":
        r"\b(?:pneumonia|covid-19|influenza\b|infection\b|sepsis|cellulitis|viral infection|herpes zoster|septic shock)\b",
    "psychiatric":
        r"\b(?:anxiety|insomnia|depression|stress|agitation|hallucination|suicidal ideation|suicide attempt|"
        r"irritability|nervousness|emotional distress|depressed mood)\b",
    "urinary":
        r"\b(?:"
        r"urinary tract infection|dysuria|cystitis|haematuria|hematuria|urinary retention|"
        r"urinary tract disorder|urinary tract pain|lower urinary tract symptoms|pollakiuria|"
        r"urinary frequency|nocturia|micturition urgency|bladder pain|chromaturia|urine abnormal"
        r")\b",
    "injection_site":
        r"\b(?:injection site|infusion site|infusion related reaction|infusion-related reaction)\b",
    "ocular_visual":
        r"\b(?:"
        r"eye irritation|conjunctivitis|vision blurred|visual impairment|blindness|photophobia|"
        r"ocular|eye pain|dry eye|cataract|"
        r"eye swelling|eye disorder|eyelid oedema|eyelid edema"
        r")\b",
    "metabolic_endocrine":
        r"\b(?:weight increased|weight decreased|blood glucose increased|blood glucose decreased|hyperglyc\w*|hypoglyc\w*|"
        r"diabetes mellitus|hyponatraemia|hyponatremia)\b",
    "hypersensitivity_allergy":
        r"\b(?:hypersensitivity|drug hypersensitivity|anaphylactic reaction|anaphylaxis|allergic reaction|anaphylactic shock|"
        r"cytokine release syndrome|infusion related reaction|"
        r"drug reaction with eosinophilia and systemic symptoms)\b",
    "injury_accident":
        r"\b(?:fall\b|fracture|injury|contusion|wound)\b",
    "pregnancy_reproductive":
        r"\b(?:abortion spontaneous|miscarriage|heavy menstrual bleeding|intermenstrual bleeding|premature baby|pregnancy)\b",
}
# ---- end of fixed values ---------------------------------------------------


def _ci(p: str) -> str:
    return "(?i)" + p


ADVERSE_V1 = RuleSet(
    name="adverse_v1",
    labels={k: _ci(v) for k, v in V1_LABELS.items()},
    drop_exact=V1_DROP_EXACT,
    drop_regex=_ci(V1_DROP_REGEX),
    fallback="other_symptom",
    distinct_terms=True,
)

ADVERSE_V2 = RuleSet(
    name="adverse_v2",
    labels={k: _ci(v) for k, v in V2_LABELS.items()},
    drop_exact=V2_DROP_EXACT,
    drop_regex=_ci(V2_DROP_REGEX),
    fallback="other_symptom",
)
