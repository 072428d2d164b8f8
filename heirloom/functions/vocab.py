"""Word lists and patterns of the kinship rules."""

# They decide which texts match.
NAME = r"[A-ZА-ЯЁ][A-Za-zА-Яа-яЁё'’\-]*(?:\s+[A-ZА-ЯЁ][A-Za-zА-Яа-яЁё'’\-]*){0,3}"
MENTION = r"[A-ZА-ЯЁ][A-Za-zА-Яа-яЁё0-9'’\-]*(?:\s+[A-ZА-ЯЁ][A-Za-zА-Яа-яЁё0-9'’\-]*){0,3}"
YEAR = r"(?:1[0-9]{3}|20[0-9]{2})"
YEARS_SUFFIX = rf"(?:\s*(?:\(|\[)\s*{YEAR}\s*[-–—/]\s*{YEAR}\s*(?:\)|\]))?"
YEARS_ANYWHERE = rf"(?:\(|\[)?\s*({YEAR})\s*[-–—/]\s*({YEAR})\s*(?:\)|\])?"
YEARS_NOTE = rf"(?:\(|\[)\s*(?:ca?\.?\s*)?{YEAR}\s*[-–—/]\s*(?:ca?\.?\s*)?{YEAR}\s*(?:\)|\])"
NOISE_SUFFIXES = ["line", "branch", "dynasty", "lineage", "house", "family", "род", "ветвь", "династия", "линия", "дом", "семья"]
MENTION_NOISE = (
    "claim claims confidence conflict evidence family genealogy parent parents person relationship relationships source status "
    "child children spouse spouses утверждение уверенность конфликт доказательство семья родитель родители человек персона связь "
    "связи источник статус ребенок дети супруг супруга"
).split()
TRIGGERS = (
    "сын сына сынов дочь дочери дети детей женат жена супруга супруг муж брак браке родила родились родилось наследник наследником "
    "отец мать внук внучка племянник племянница son daughter child children spouse wife husband married born heir"
).split()
GENERIC_NAMES = [
    *"император императрица царь царица царевич царевна князь княгиня первая вторая первый второй он она ему ей они".split(),
    "у них",
    *"spouse wife husband emperor empress king queen".split(),
]
CLAIM_TYPES = ["parent_child", "spouse", "person_profile"]
PARENT_TYPES = ["parent_child", "parent_of", "father_of", "mother_of"]
WEAK_TYPES = ["relative", "associated_with", "knows"]
AVUNCULAR_TYPES = ["uncle_of", "aunt_of", "aunt_uncle_of"]
PARENT_INTENT = "parent parents father mother родитель родители отец мать папа мама".split()
CHILD_INTENT = "child children son sons daughter daughters descendant descendants kids ребенок ребёнок дети сын сыновья дочь дочери потомок потомки".split()
SPOUSE_INTENT = "spouse spouses wife wives husband husbands married marriage супруг супруга супруги муж жена брак женат замужем".split()
RELATION_INTENT = "connected connection connections related relation relations relationship relationships связан связана связаны связь связи родство".split()
MALE = "m male man boy masculine masc м муж мужчина мужской".split()
FEMALE = "f female woman girl feminine fem ж жен женщина женский".split()
PARENT_GAP = (12, 80)
CONFIDENCE = {"parent_child": 0.8, "spouse": 0.75, "sibling": 0.75, "transfer": 0.68, "avuncular": 0.72, "grand": 0.73, "cousin": 0.70}

#: (claim type, pattern without flags); the third group is a second parent. Names keep their case, cues do not.
_N = f"(?-i:{NAME}{YEARS_SUFFIX})"
_NU = f"(?-iu:{NAME}{YEARS_SUFFIX})"


def claim_patterns(name: str) -> list[tuple[str, str]]:
    return [
        ("parent_child", rf"({name})\s+(?:is|was)\s+(?:the\s+)?(?:son|daughter|child)\s+of\s+({name})(?:\s+and\s+({name}))?"),
        ("parent_child", rf"({name})\s*(?:—|-)?\s*(?:сын|дочь|ребенок)\s+({name})(?:\s+и\s+({name}))?"),
        ("spouse", rf"({name})\s+(?:is|was)?\s*(?:married\s+to|spouse\s+of)\s+({name})()"),
        ("spouse", rf"({name})\s*(?:—|-)?\s*(?:муж|жена|супруг|супруга)\s+({name})()"),
    ]


JAVA_CLAIMS = [(t, f"(?iu){p}") for t, p in claim_patterns(_NU)]
#: What every match of each pattern holds.
CLAIM_CUES = [r"(?i)(?:son|daughter|child)\s+of", r"(?iu)сын|дочь|ребенок", r"(?i)married\s+to|spouse\s+of", r"(?iu)муж|жена|супруг"]
RE2_CLAIMS = [(t, f"(?i){p}") for t, p in claim_patterns(_N)]
HEADINGS = [
    r"^([А-ЯЁA-Z][А-Яа-яЁёA-Za-z]+(?:\s+[IVXLCDM]+|\s+[А-ЯЁA-Z][А-Яа-яЁёA-Za-z]+){0,3})\s*\(",
    r"^(?:Царствование|Правление|При)\s+([А-ЯЁA-Z][А-Яа-яЁёA-Za-z]+(?:\s+[IVXLCDM]+|\s+[А-ЯЁA-Z][А-Яа-яЁёA-Za-z]+){0,3})",
]
STRIP = r""" ,.;:!?\t\n"'`«»“”()\[\]{}"""

# Cues in quotes, each a whole word or phrase, and name parts.
PARENT_HINTS = "сын сына сыном сыновей дочь дочери дочерью детей ребенок ребёнок child children son daughter".split()
PARENT_CUES = ["son of", "daughter of", "child of", "сын", "сына", "дочь", "дочери"]
PARENT_BEFORE = ["сын", "сына", "дочь", "дочери", "child of", "son of", "daughter of"]
PARENT_AFTER = "родил родила родились имел имела had children child".split()
SPOUSE_CUES = "wife husband spouse married супруга супруг муж жена брак".split()
COLLATERAL_CUES = "brother sister uncle aunt cousin nephew niece брат сестра дядя тётя тетя кузен кузина племянник племянница".split()
SEGMENT_CUES = "сын дочь child son daughter".split()
NIBLING_CUES = "племянник племянница niece nephew".split()
NIBLING_MARKS = ["племянник", "племянниц", " niece ", " nephew "]
PATRONYMICS = "ович евич овна евна ична оглы кызы".split()
PATRONYMIC_ENDINGS = "ович евич ич овна евна ична инична оглы кызы".split()
NOT_PATRONYMICS = "цесаревич царевич королевич княжич".split()
FINAL_VOWELS = "аеиоуыэюяьй"
TITLES = "царь царица царевич царевна император императрица король королева князь княгиня государь государыня великий великая the king queen emperor empress tsar".split()
KIN_TYPES = (
    "parent_child parent_of father_of mother_of child_of spouse sibling sibling_of brother_of sister_of grandparent_of grandfather_of grandmother_of "
    "grandchild_of grandson_of granddaughter_of aunt_uncle_of aunt_of uncle_of nibling_of nephew_of niece_of cousin_of"
).split()
ANCHOR_TYPES = "relative associated_with knows works_with colleague_of ally_of".split()
PROMOTION_CONFIDENCE = 0.75
