"""Drug-name keyword lists (substring matches on the prescription ``drug``).

FIXED VALUES.  These keyword lists must equal the reference's; they are given
plainly, in the reference's order (duplicates kept; they have no effect).
"""

from __future__ import annotations

# matched on UPPER(drug)
ACEI = ["BENAZEPRIL", "CAPTOPRIL", "ENALAPRIL", "FOSINOPRIL", "LISINOPRIL", "MOEXIPRIL",
        "PERINDOPRIL", "QUINAPRIL", "RAMIPRIL", "TRANDOLAPRIL"]

ARB = ["AZILSARTAN", "EDARBI", "CANDESARTAN", "ATACAND", "IRBESARTAN", "AVAPRO", "LOSARTAN",
       "COZAAR", "OLMESARTAN", "BENICAR", "TELMISARTAN", "MICARDIS", "VALSARTAN", "DIOVAN",
       "SACUBITRIL", "ENTRESTO"]

NSAID = ["ASPIRIN", "BROMFENAC", "CELECOXIB", "DICLOFENAC", "DIFLUNISAL", "ETODOLAC", "FENOPROFEN",
         "FLURBIPROFEN", "IBUPROFEN", "INDOMETHACIN", "KETOPROFEN", "MEFENAMIC ACID", "MELOXICAM",
         "NABUMETONE", "NAPROXEN", "NEPAFENAC", "OXAPROZIN", "PIROXICAM", "SULINDAC", "TOLMETIN"]

# matched on LOWER(drug)
ANTIBIOTIC = [
    "adoxa", "ala-tet", "alodox", "amikacin", "amikin", "amoxicill", "amphotericin",
    "anidulafungin", "ancef", "clavulanate", "ampicillin", "augmentin", "avelox", "avidoxy",
    "azactam", "azithromycin", "aztreonam", "axetil", "bactocill", "bactrim", "bactroban",
    "bethkis", "biaxin", "bicillin l-a", "cayston", "cefazolin", "cedax", "cefoxitin",
    "ceftazidime", "cefaclor", "cefadroxil", "cefdinir", "cefditoren", "cefepime", "cefotan",
    "cefotetan", "cefotaxime", "ceftaroline", "cefpodoxime", "cefpirome", "cefprozil",
    "ceftibuten", "ceftin", "ceftriaxone", "cefuroxime", "cephalexin", "cephalothin",
    "cephapririn", "chloramphenicol", "cipro", "ciprofloxacin", "claforan", "clarithromycin",
    "cleocin", "clindamycin", "cubicin", "dicloxacillin", "dirithromycin", "doryx", "doxycy",
    "duricef", "dynacin", "ery-tab", "eryped", "eryc", "erythrocin", "erythromycin", "factive",
    "flagyl", "fortaz", "furadantin", "garamycin", "gentamicin", "kanamycin", "keflex", "kefzol",
    "ketek", "levaquin", "levofloxacin", "lincocin", "linezolid", "macrobid", "macrodantin",
    "maxipime", "mefoxin", "metronidazole", "meropenem", "methicillin", "minocin", "minocycline",
    "monodox", "monurol", "morgidox", "moxatag", "moxifloxacin", "mupirocin", "myrac", "nafcillin",
    "neomycin", "nicazel doxy 30", "nitrofurantoin", "norfloxacin", "noroxin", "ocudox",
    "ofloxacin", "omnicef", "oracea", "oraxyl", "oxacillin", "pc pen vk", "pce dispertab",
    "panixine", "pediazole", "penicillin", "periostat", "pfizerpen", "piperacillin", "tazobactam",
    "primsol", "proquin", "raniclor", "rifadin", "rifampin", "rocephin", "smz-tmp", "septra",
    "septra ds", "septra", "solodyn", "spectracef", "streptomycin", "sulfadiazine",
    "sulfamethoxazole", "trimethoprim", "sulfatrim", "sulfisoxazole", "suprax", "synercid",
    "tazicef", "tetracycline", "timentin", "tobramycin", "trimethoprim", "unasyn", "vancocin",
    "vancomycin", "vantin", "vibativ", "vibra-tabs", "vibramycin", "zinacef", "zithromax", "zosyn",
    "zyvox",
]
# dictionary exclusions for antibiotics
ANTIBIOTIC_EXCLUDED_DRUG_TYPES = ["BASE"]
ANTIBIOTIC_EXCLUDED_ROUTES = ["OU", "OS", "OD", "AU", "AS", "AD", "TP"]
ANTIBIOTIC_EXCLUDED_ROUTE_WORDS = ["ear", "eye"]
ANTIBIOTIC_EXCLUDED_DRUG_WORDS = ["cream", "desensitization", "ophth oint", "gel"]
