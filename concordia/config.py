"""Dimensions, dictionaries and thresholds; every operator takes them as parameters with these defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Names, codes, word lists and thresholds that results depend on.

TOPICS = ["migration", "ukraine_russia", "enlargement", "defence", "energy", "fiscal", "rule_of_law", "trade"]

EU = ["AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR", "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK", "SI", "ES", "SE"]
EXTERNAL = ["US", "GB", "RU", "UA", "CN", "TR"]

COUNTRY_ALIASES = {
    "AT": ["austria", "austrian"], "BE": ["belgium", "belgian"], "BG": ["bulgaria", "bulgarian"], "HR": ["croatia", "croatian"],
    "CY": ["cyprus", "cypriot"], "CZ": ["czech republic", "czechia", "czech"], "DK": ["denmark", "danish"], "EE": ["estonia", "estonian"],
    "FI": ["finland", "finnish"], "FR": ["france", "french"], "DE": ["germany", "german", "deutschland"], "GR": ["greece", "greek"],
    "HU": ["hungary", "hungarian"], "IE": ["ireland", "irish"], "IT": ["italy", "italian"], "LV": ["latvia", "latvian"],
    "LT": ["lithuania", "lithuanian"], "LU": ["luxembourg", "luxembourgish"], "MT": ["malta", "maltese"],
    "NL": ["netherlands", "the netherlands", "dutch", "holland"], "PL": ["poland", "polish"], "PT": ["portugal", "portuguese"],
    "RO": ["romania", "romanian"], "SK": ["slovakia", "slovak"], "SI": ["slovenia", "slovenian"], "ES": ["spain", "spanish"], "SE": ["sweden", "swedish"],
    "US": ["united states", "united states of america", "usa", "u.s.", "u.s.a.", "american"],
    "GB": ["united kingdom", "u.k.", "britain", "great britain", "british"],
    "RU": ["russia", "russian", "russian federation", "kremlin"], "UA": ["ukraine", "ukrainian", "kyiv", "kiev"],
    "CN": ["china", "chinese", "prc", "people's republic of china"], "TR": ["turkey", "turkish", "turkiye", "türkiye", "ankara"],
}

TOPIC_KEYWORDS = {
    "migration": ["migration", "migrant", "migrants", "asylum", "asylum seeker", "asylum seekers", "refugee", "refugees", "border", "border control", "border protection", "schengen", "frontex", "relocation", "quota", "quotas", "migrant quota", "migration pact", "asylum pact", "illegal migration", "irregular migration", "return policy"],
    "ukraine_russia": ["ukraine", "russia", "russian", "ukrainian", "sanctions", "eu sanctions", "military aid", "security assistance", "peace talks", "ceasefire", "war in ukraine", "russian aggression", "support for ukraine", "arms delivery", "defence aid"],
    "enlargement": ["eu enlargement", "enlargement", "accession", "accession talks", "candidate country", "candidate status", "membership talks", "western balkans", "ukraine accession", "moldova accession", "joining the eu", "eu membership bid"],
    "defence": ["defence", "defense", "security policy", "military cooperation", "military spending", "defence spending", "defense spending", "nato", "armed forces", "defence industry", "defense industry", "joint procurement", "european defence", "security cooperation"],
    "energy": ["energy", "energy security", "gas", "natural gas", "lng", "oil", "pipeline", "pipelines", "electricity market", "energy supply", "energy diversification", "renewables", "renewable energy", "nuclear energy", "power market"],
    "fiscal": ["fiscal policy", "budget", "budget rules", "economic governance", "deficit", "debt", "public debt", "inflation", "stability pact", "growth pact", "eu budget", "fiscal rules", "spending rules", "economic coordination"],
    "rule_of_law": ["rule of law", "judicial independence", "democracy", "constitutional reform", "eu funds", "conditionality", "media freedom", "corruption", "institutional reform", "civil liberties", "fundamental rights", "article 7"],
    "trade": ["trade", "trade policy", "tariff", "tariffs", "industrial policy", "strategic autonomy", "supply chain", "supply chains", "china policy", "trade agreement", "free trade", "market access", "export controls", "economic security"],
}

# In order of priority; a title that matches none is about trade, whose own list therefore decides nothing.
VOTE_TOPIC_KEYWORDS = {
    "ukraine_russia": ["ukraine", "ukrainian", "russia", "russian", "moscow", "kremlin", "crimea", "donbas", "donetsk", "luhansk", "zelensky", "putin", "war of aggression", "aggression against ukraine", "sanctions on russia", "military support for ukraine", "reconstruction of ukraine", "ukrajna", "orosz", "oroszorszag", "szankcio", "szankció", "agression russe", "guerre en ukraine"],
    "migration": ["migration", "migrant", "migrants", "asylum", "asylum seekers", "refugee", "refugees", "schengen", "border control", "external borders", "returns", "return policy", "readmission", "relocation", "resettlement", "smuggling", "migrant smuggling", "human trafficking", "trafficking in human beings", "frontex", "visa policy", "visa suspension", "lampedusa", "mediterranean", "mediterranean route", "menekult", "menekült", "migracio", "migráció", "hatar", "határ", "asile", "réfugié", "refugie", "retours"],
    "enlargement": ["enlargement", "accession", "candidate country", "candidate status", "membership application", "pre accession", "pre-accession", "western balkans", "albania", "serbia", "montenegro", "north macedonia", "bosnia", "kosovo", "moldova", "georgia", "turkey accession", "türkiye", "bovites", "bővítés", "csatlakozas", "csatlakozás", "tagjelolt", "tagjelölt", "élargissement", "adhesion"],
    "defence": ["defence", "defense", "military", "armed forces", "security assistance", "weapon", "weapons", "ammunition", "missile", "air defence", "air defense", "cyber defence", "cyber defense", "battlefield", "troops", "nato", "vedel", "védel", "katonai", "hadero", "haderő", "défense", "militaire"],
    "energy": ["energy", "gas", "oil", "electricity", "power market", "renewable", "nuclear", "hydrogen", "grid", "pipeline", "lng", "emissions trading", "carbon market", "fit for 55", "climate neutrality", "energia", "gaz", "gáz", "villamos", "atomenergia", "énergie", "pétrole", "gaz naturel"],
    "rule_of_law": ["rule of law", "judicial", "judiciary", "court", "courts", "fundamental rights", "civil liberties", "democracy", "corruption", "anti corruption", "anti-corruption", "media freedom", "press freedom", "detention", "political prisoners", "political prisoner", "human rights", "constitutional", "election integrity", "independent institutions", "civil society", "jogallam", "jogállam", "igazsagszolgaltatas", "igazságszolgáltatás", "alapjog", "korrupcio", "korrupció", "etat de droit", "état de droit", "droits fondamentaux"],
    "fiscal": ["budget", "fiscal", "deficit", "debt", "appropriations", "tax", "taxation", "vat", "financial framework", "multiannual financial framework", "mff", "recovery facility", "own resources", "economic governance", "monetary", "inflation", "public finances", "koltsegvetes", "költségvetés", "fiskalis", "fiskális", "adossag", "adósság", "budgétaire", "fiscalité"],
}

# Country codes of coded events (three letters, and two-letter ones of another system) to ISO two-letter codes.
CODED_COUNTRIES = {
    "AUT": "AT", "AU": "AT", "BEL": "BE", "BE": "BE", "BGR": "BG", "BU": "BG", "HRV": "HR", "HR": "HR", "CYP": "CY", "CY": "CY", "CZE": "CZ", "CZR": "CZ", "EZ": "CZ",
    "DNK": "DK", "DNM": "DK", "DA": "DK", "EST": "EE", "EN": "EE", "FIN": "FI", "FI": "FI", "FRA": "FR", "FR": "FR", "DEU": "DE", "GER": "DE", "GM": "DE",
    "GRC": "GR", "GRE": "GR", "GR": "GR", "HUN": "HU", "HU": "HU", "IRL": "IE", "IRE": "IE", "EI": "IE", "ITA": "IT", "IT": "IT", "LVA": "LV", "LAT": "LV", "LG": "LV",
    "LTU": "LT", "LIT": "LT", "LH": "LT", "LUX": "LU", "LU": "LU", "MLT": "MT", "MT": "MT", "NLD": "NL", "NET": "NL", "NL": "NL", "POL": "PL", "PL": "PL",
    "PRT": "PT", "POR": "PT", "PO": "PT", "ROU": "RO", "ROM": "RO", "RO": "RO", "SVK": "SK", "SLO": "SK", "LO": "SK", "SVN": "SI", "SLV": "SI", "SI": "SI",
    "ESP": "ES", "SPN": "ES", "SP": "ES", "SWE": "SE", "SWD": "SE", "SW": "SE",
    "USA": "US", "US": "US", "GBR": "GB", "UK": "GB", "GB": "GB", "RUS": "RU", "RS": "RU", "UKR": "UA", "UP": "UA", "CHN": "CN", "CH": "CN", "TUR": "TR", "TU": "TR",
}
# Three-letter codes of the EU's countries.
ISO3 = {
    "AUT": "AT", "BEL": "BE", "BGR": "BG", "HRV": "HR", "CYP": "CY", "CZE": "CZ", "DNK": "DK", "EST": "EE", "FIN": "FI", "FRA": "FR", "DEU": "DE", "GRC": "GR", "HUN": "HU", "IRL": "IE",
    "ITA": "IT", "LVA": "LV", "LTU": "LT", "LUX": "LU", "MLT": "MT", "NLD": "NL", "POL": "PL", "PRT": "PT", "ROU": "RO", "SVK": "SK", "SVN": "SI", "ESP": "ES", "SWE": "SE",
}

GROUPS = {
    "PPE": "EPP", "EPP": "EPP", "SD": "S&D", "S&D": "S&D", "RE": "Renew", "RENEW": "Renew", "VERTS/ALE": "Greens/EFA", "GREENS/EFA": "Greens/EFA",
    "GREEN_EFA": "Greens/EFA", "ECR": "ECR", "ID": "ID", "PFE": "PfE", "PFE.": "PfE", "THE LEFT": "The Left", "GUE/NGL": "The Left", "GUE_NGL": "The Left",
    "LEFT": "The Left", "ESN": "ESN", "NI": "NI",
}
POSITIONS = {
    "FOR": "for", "IN_FAVOUR": "for", "IN FAVOUR": "for", "FAVOUR": "for", "FAVOR": "for", "AGAINST": "against", "ABSTENTION": "abstain", "ABSTAIN": "abstain",
}
VOTE_SCORE = {"for": "1", "abstain": "0.25", "against": "-1"}

# Words that tell a member's position, in the order they are tried; contained anywhere.
POSITION_WORDS = {
    "abstain": ["abstention", "abstain", "abstained", "tartózk"],
    "against": ["against", "rejected", "elutasít", "ellene"],
    "for": ["for", "adopted", "approved", "favour", "favor", "igen", "mellette"],
}

# Labels of reports (Hungarian).
TOPIC_LABELS = {
    "migration": "migráció", "ukraine_russia": "Ukrajna / Oroszország", "enlargement": "bővítés", "defence": "védelem", "energy": "energia",
    "fiscal": "fiskális politika", "rule_of_law": "jogállamiság", "trade": "gazdaság / belső piac",
}
LAYER_LABELS = {"rss": "RSS", "gdelt": "GDELT", "combined": "Combined", "votes": "Votes"}
MODE_LABELS = {"all": "teljes nézet", "internal": "EU belső", "external": "EU külső"}
STATUS_LABELS = {"gained": "újonnan kialakult", "lost": "megszűnő", "improved": "erősödő", "declined": "gyengülő", "stable": "stabil"}
RELATION_LABELS = {"strong": "erős", "medium": "közepes", "weak": "gyenge"}
TREND_LABELS = {"up": "javuló", "down": "romló", "flat": "stabil"}

WINDOWS = {"7d": 7, "30d": 30, "90d": 90}
MODES = ["all", "internal", "external"]


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the network builders."""

    min_conflict_weight: float = 0.15
    min_edge_count: int = 5
    min_edge_weight: float = 0.60
    min_similarity: float = 0.20
    divisive_min: int = 2
    min_relationship: float = 5.0


@dataclass(frozen=True)
class Weights:
    """Shares of the three components of the relationship index."""

    direct: float = 0.50
    similarity: float = 0.30
    topic: float = 0.20


VOTE_WEIGHTS = Weights(0.45, 0.35, 0.20)
