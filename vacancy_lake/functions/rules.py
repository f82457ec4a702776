"""Rule data only: word lists, lookup tables and patterns that decide results.

Everything here is a default; every operator takes its rules as an argument, so
another market can bring its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _terms(text: str) -> tuple[str, ...]:
    return tuple(t.strip() for t in text.replace("\n", ",").split(",") if t.strip())


# ---------------------------------------------------------------------------
# Skill vocabulary (canonical lower-case terms).
# ---------------------------------------------------------------------------
SKILL_TERMS = _terms(
    """
    python, java, javascript, typescript, kotlin, swift, php, ruby, rust, scala, sql, html, css, bash,
    powershell, golang, react, angular, vue, node, django, flask, spring, laravel, rails, .net, dotnet,
    graphql, rest, kafka, redis, elasticsearch, mongodb, postgresql, mysql, sqlite, pandas, numpy,
    tensorflow, pytorch, spark, hadoop, airflow, dbt, aws, azure, gcp, kubernetes, docker, terraform,
    ansible, jenkins, gitlab, github, linux, windows, vmware, etl, excel, tableau, looker, snowflake,
    databricks, bigquery, synapse, sap, erp, crm, salesforce, power bi, business intelligence,
    data engineering, data science, machine learning, deep learning, nlp, computer vision, statistics,
    security, cybersecurity, penetration testing, compliance, gdpr, iso 27001, devops, sre, mlops, agile,
    scrum, kanban, ci/cd, microservices, api, ui, ux, seo, sem, recruiting, digital marketing,
    social media, customer service, warehouse, healthcare, hospitality, retail, education, construction,
    network administration, systems administration, information systems, automation, blockchain, iot,
    software development, data processing, english, german, french, sales, accounting, procurement,
    logistics, spring boot, express, nestjs, hibernate, grpc, protobuf, nginx, selenium, jira, confluence,
    figma, microsoft fabric, azure data factory, azure synapse, oracle, pl/sql, t-sql, cassandra, dynamodb,
    quarkus, opencv, cuda, mlflow, delta lake, apache spark, react native, flutter, swiftui, svelte,
    webpack, jest, cypress, postman, openapi, swagger, sharepoint, power apps, power automate, qlik,
    informatica, talend, matlab, solidity, ansible tower, prometheus, grafana, splunk, elk stack,
    frontend, backend, fullstack, presales, video editing, vfx, quality assurance, financial services,
    field sales
    """
)

# Spelling variants of skills, one or more canonical terms each.
SKILL_ALIASES: dict[str, tuple[str, ...]] = {
    "js": ("javascript",), "ts": ("typescript",), "react.js": ("react",), "reactjs": ("react",),
    "node.js": ("node",), "nodejs": ("node",), "vue.js": ("vue",), "angularjs": ("angular",),
    "c#": (".net",), "c sharp": (".net",), "csharp": (".net",), "dot net": (".net",),
    ".net core": (".net",), "asp.net": (".net",), "k8s": ("kubernetes",), "kubernetess": ("kubernetes",),
    "tf": ("tensorflow",), "postgres": ("postgresql",), "psql": ("postgresql",), "ms sql": ("sql",),
    "mssql": ("sql",), "ms excel": ("excel",), "powerbi": ("power bi",), "power-bi": ("power bi",),
    "ml": ("machine learning",), "ai": ("machine learning",), "bi": ("business intelligence",),
    "ds": ("data science",), "sap/erp consulting": ("sap", "erp"),
    "system and network administration": ("network administration", "systems administration"),
    "online marketing": ("digital marketing",), "recruitment and selection": ("recruiting",),
    "data engineer": ("data engineering",), "automation engineering": ("automation",),
    "vertrieb": ("sales",), "bpo": ("customer service",), "telecalling": ("customer service",),
    "telecaller": ("customer service",), "einkauf": ("procurement",), "buchhaltung": ("accounting",),
    "buchhalter": ("accounting",), "buchhalterin": ("accounting",), "lager": ("logistics",),
    "logistik": ("logistics",), "pflege": ("healthcare",), "krankenpflege": ("healthcare",),
    "gastronomie": ("hospitality",), "einzelhandel": ("retail",), "lagerist": ("warehouse",),
    "call center": ("customer service",), "pl/sql": ("pl/sql",), "pl sql": ("pl/sql",),
    "springboot": ("spring boot",), "spring-boot": ("spring boot",), "ms fabric": ("microsoft fabric",),
    "fabric (microsoft)": ("microsoft fabric",), "azure fabric": ("microsoft fabric",),
    "next.js": ("react",), "nextjs": ("react",), "nestjs": ("node",), "go lang": ("golang",),
    "oracle pl/sql": ("oracle", "pl/sql"), "oracle sql": ("oracle", "sql"), "t sql": ("t-sql",),
    "tsql": ("t-sql",), "pyspark": ("apache spark",), "py torch": ("pytorch",),
    "scikit learn": ("machine learning",), "sklearn": ("machine learning",), "powerapps": ("power apps",),
    "influencer": ("social media", "digital marketing"), "full-stack": ("fullstack",),
    "full stack": ("fullstack",),
}

# Words a single token or tag may never turn into a skill. A stop word only matters when it
# is also a term or an alias, and of the known stop words exactly this one is; bring a longer list together
# with a longer vocabulary.
SKILL_STOP = ("sales",)


@dataclass(frozen=True)
class Vocabulary:
    """Skill rules: `alias_ngrams` also lets aliases of several words fire inside running text."""

    terms: tuple[str, ...] = SKILL_TERMS
    aliases: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SKILL_ALIASES))
    stop: tuple[str, ...] = SKILL_STOP
    alias_ngrams: bool = False


# ---------------------------------------------------------------------------
# Places of one country (states, large cities, spelling variants).
# ---------------------------------------------------------------------------
INDIA_STATES = _terms(
    """
    andhra pradesh, arunachal pradesh, assam, bihar, chhattisgarh, goa, gujarat, haryana,
    himachal pradesh, jharkhand, karnataka, kerala, madhya pradesh, maharashtra, manipur, meghalaya,
    mizoram, nagaland, odisha, punjab, rajasthan, sikkim, tamil nadu, telangana, tripura, uttar pradesh,
    uttarakhand, west bengal, delhi, jammu and kashmir, ladakh, puducherry, chandigarh,
    dadra and nagar haveli and daman and diu, lakshadweep, andaman and nicobar islands
    """
)
INDIA_CITIES = {
    "mumbai": "maharashtra", "pune": "maharashtra", "nagpur": "maharashtra", "nashik": "maharashtra",
    "thane": "maharashtra", "navi mumbai": "maharashtra", "bangalore": "karnataka",
    "hyderabad": "telangana", "chennai": "tamil nadu", "coimbatore": "tamil nadu",
    "madurai": "tamil nadu", "kolkata": "west bengal", "ahmedabad": "gujarat", "surat": "gujarat",
    "vadodara": "gujarat", "jaipur": "rajasthan", "lucknow": "uttar pradesh", "kanpur": "uttar pradesh",
    "noida": "uttar pradesh", "ghaziabad": "uttar pradesh", "gurgaon": "haryana", "faridabad": "haryana",
    "indore": "madhya pradesh", "bhopal": "madhya pradesh", "kozhikode": "kerala", "kochi": "kerala",
    "thiruvananthapuram": "kerala", "visakhapatnam": "andhra pradesh", "vijayawada": "andhra pradesh",
    "patna": "bihar", "ranchi": "jharkhand", "bhubaneswar": "odisha", "guwahati": "assam",
    "chandigarh": "chandigarh", "mysore": "karnataka", "mysuru": "karnataka",
}
INDIA_ALIASES = {"orissa": "odisha", "bengaluru": "bangalore", "gurugram": "gurgaon"}
# Spellings known only to the state-per-posting rules, and cities known only to one of their two branches.
GEO_CITY_SPELLINGS = {"bengaluru": "karnataka", "gurugram": "haryana"}
GEO_ALONE_ONLY = {"tiruchirappalli": "tamil nadu", "anantapur": "andhra pradesh"}
GEO_WITH_COUNTRY_ONLY = {"new delhi": "delhi", "dehradun": "uttarakhand"}
# (city, text the second segment must contain) -> state
GEO_PAIRS = (("noida", "=ghaziabad", "uttar pradesh"), ("kochi", "ernakulam", "kerala"),
             ("durgapur", "bardhaman", "west bengal"), ("new delhi", "=delhi", "delhi"))


@dataclass(frozen=True)
class PlaceRules:
    """Country place rules; lookups are literal maps whose size is the size of this object."""

    country: str = "india"
    country_forms: tuple[str, ...] = ("india", "in")
    context_forms: tuple[str, ...] = ("india", "in", "bharat")
    states: tuple[str, ...] = INDIA_STATES
    cities: dict[str, str] = field(default_factory=lambda: dict(INDIA_CITIES))
    aliases: dict[str, str] = field(default_factory=lambda: dict(INDIA_ALIASES))
    geo_spellings: dict[str, str] = field(default_factory=lambda: dict(GEO_CITY_SPELLINGS))
    geo_alone: dict[str, str] = field(default_factory=lambda: dict(GEO_ALONE_ONLY))
    geo_with_country: dict[str, str] = field(default_factory=lambda: dict(GEO_WITH_COUNTRY_ONLY))
    geo_pairs: tuple[tuple[str, str, str], ...] = GEO_PAIRS


# Whole-location spellings, display names that are only a country, and the country codes whose
# two-level hierarchy is (country, place).
LOCATION_ALIASES = {"frankfurt": "frankfurt am main", "berlin, germany": "berlin"}
COUNTRY_DISPLAY_NAMES = ("india", "in", "bharat", "united states", "usa", "united kingdom", "uk", "uae",
                         "germany", "france")
COUNTRY_FIRST = ("india", "in", "usa", "uk")

# Vague category labels and tags, and second words that mark a cut-off title.
GENERIC_CATEGORY_LABELS = ("it jobs", "jobs", "job", "general", "all jobs", "vacancies", "careers")
GENERIC_CATEGORY_TAGS = ("jobs", "job", "all-jobs", "general", "vacancies", "careers", "all", "other")
TITLE_FRAGMENT_SECOND_WORDS = ("of", "and", "the", "&")

# Work-mode patterns, first match wins.
WORK_MODE_PATTERNS = (
    ("hybrid", r"\bhybrid\b"),
    ("remote", r"\b(remote|wfh|work\s+from\s+home|work-from-home|work\s+remotely|fully\s+remote|remote\s+work"
               r"|remote\s+role|telecommut(?:e|ing))\b"),
    ("onsite", r"\b(onsite|on-site|on\s+site|office-based|office\s+based|report(?:ing)?\s+to\s+office"
               r"|on-?prem(?:ises)?|work\s+from\s+office|office\s+only|based\s+in\s+office)\b"),
)

# Named entities replaced natively; `amp` must stay last. Others go through the long-tail path.
HTML_ENTITIES = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("#39", "'"), ("nbsp", " "),
                 ("copy", "©"), ("reg", "®"), ("middot", "·"), ("ndash", "–"), ("mdash", "—"),
                 ("hellip", "…"), ("euro", "€"), ("auml", "ä"), ("ouml", "ö"), ("uuml", "ü"), ("Auml", "Ä"),
                 ("Ouml", "Ö"), ("Uuml", "Ü"), ("szlig", "ß"), ("amp", "&"))

# ---------------------------------------------------------------------------
# Role title noise, and role families in priority order (first match wins).
# Deviation on purpose: single backslashes, i.e. the documented intent of the rules.
# ---------------------------------------------------------------------------
ROLE_NOISE = (
    (r"(?i)(\(m/w/d\)|\(m/f/x\)|\(w/m/d\)|\(m/f/d\)|\(f/m/d\)|\(d/m/w\)|\(d/f/m\)|\(m/w/x\))", " "),
    (r"(?i)(all genders|alle\s+geschlechter|geschlecht\s*egal)", " "),
    (r"(?i)ref\.?\s*nr\.?\s*:?\s*[\w./#-]+", " "),
    (r"(?i)(job\s*id\s*[:#]?\s*[\w-]+|stellennr\.?\s*:?\s*[\w-]+)", " "),
    (r"(?i)(\(remote\)|\(hybrid\)|\(onsite\)|\(vor ort\))", " "),
    (r"[,;:|/\\.-]{2,}", " "),
    (r"\s+", " "),
)
ROLE_FAMILIES = (
    ("cybersecurity",
     r"(cyber\s*security|cybersecurity|informationssicherheit|information security|it[\s-]*security|pentest"
     r"|penetration|appsec|soc analyst|security engineer|security architect)"),
    ("data_analytics",
     r"(data\s*scientist|data\s*science|data\s*engineer|machine\s*learning|\bml\s+engineer|analytics\s*engineer"
     r"|business\s*intelligence|\bbi\s+developer|datenanalyst|datenanalyse|data\s*analyst"
     r"|business\s*analyst.*\b(data|analytics|bi)\b|research\s*scientist.*\b(data|ml)\b|etl|data\s*warehouse|dwh)"),
    ("data_analytics", r"(\bda\b|\bde\b)\s*(engineer|developer|analyst)|power\s*bi|tableau|looker"),
    ("devops_cloud_infrastructure",
     r"(devops|dev\s*ops|site\s*reliability|\bsre\b|kubernetes|\bk8s\b|cloud\s*engineer|platform\s*engineer"
     r"|infrastructure|cloud\s*architect|terraform|ansible|ci/cd)"),
    ("customer_success_support",
     r"(customer\s*success|customer\s*support|client\s*success|help\s*desk|helpdesk|service\s*desk|kundenservice"
     r"|kundenbetreuung|technical\s*support|it\s*support|2nd\s*line|1st\s*line|support\s*specialist"
     r"|support\s*engineer)"),
    ("software_engineering",
     r"(software|entwickler|entwicklung|developer|programmer|programmier|full[\s-]?stack|front[\s-]?end"
     r"|back[\s-]?end|web[\s-]?entwickler|softwareingenieur|software[\s-]?ingenieur|application\s*engineer"
     r"|applications\s*engineer|solutions\s*engineer|\bjava\b|\bpython\b|\b\.net\b|\bphp\b|react|angular"
     r"|node\.js|typescript|mobile\s*developer|app\s*developer|embedded\s*software)"),
    ("product_program_project",
     r"(product\s*owner|product\s*manager|projektmanager|project\s*manager|program\s*manager|programmmanager"
     r"|scrum\s*master|agile\s*coach|delivery\s*manager|release\s*train|technical\s*project)"),
    ("marketing_content_growth",
     r"(marketing|growth|content\s*manager|content\s*marketing|seo|sem|social\s*media|brand|kommunikation"
     r"|communications|copywriter)"),
    ("sales_business_development",
     r"(sales|vertrieb|business\s*development|\bbd\b|account\s*executive|account\s*manager|key\s*account"
     r"|inside\s*sales|aussendienst|innendienst|verkauf)"),
    ("finance_accounting",
     r"(finance|financial|accountant|accounting|buchhaltung|controlling|controller|treasury|audit|tax|finanz)"),
    ("hr_recruiting",
     r"(\bhr\b|human\s*resources|recruiter|recruiting|talent\s*acquisition|people\s*partner|personal"
     r"|personalreferent|people\s*operations)"),
    ("design_creative",
     r"(ux\s*design|ui\s*design|product\s*design|graphic\s*design|designer|creative\s*director|\bux\b|\bui\b"
     r"|motion\s*design)"),
    ("legal_compliance",
     r"(legal\s*counsel|corporate\s*counsel|compliance\s*officer|\bjurist\b|rechtsanwalt|paralegal"
     r"|legal\s*advisor)"),
    ("hardware_electronics_embedded",
     r"(firmware|hardware\s*engineer|elektronik|electronics\s*engineer|semiconductor|halbleiter|pcb|asic|fpga"
     r"|\bembedded\s+systems\b|\bembedded\s+hardware\b)"),
    ("consulting", r"(consultant|consulting|berater|beratung|advisory|professional\s*services)"),
    ("operations_administration",
     r"(operations\s*manager|office\s*manager|executive\s*assistant|administrator|administration|verwaltung"
     r"|sekretär|facility|einkauf|procurement|logistics|supply\s*chain)"),
)
UNKNOWN_FAMILY = "unknown_other"
EMPTY_TITLE = "(empty title)"

# ---------------------------------------------------------------------------
# Employer names.
# ---------------------------------------------------------------------------
LEGAL_SUFFIX = (r"(?i)\s+(gmbh|g\.m\.b\.h\.|ag|ug|ltd\.?|llc|inc\.?|corp\.?|corporation|s\.a\.|s\.l\.|bv|plc|kg"
                r"|ohg|gbr|mbh|co\.|company)\.?\s*$")
UNKNOWN_EMPLOYER, UNKNOWN_EMPLOYER_LABEL = "(unknown employer)", "Unknown employer"
LONG_TAIL, LONG_TAIL_LABEL = "__LONG_TAIL__", "Remaining employers (combined)"
EMPLOYER_CASE_RULES = (
    (r"(?i)\.ai$", ".ai"), (r"(?i)\.io$", ".io"), (r"(?i)Gmbh", "GmbH"), (r"(?i) Se$", " SE"),
    (r"(?i) Ag$", " AG"), (r"(?i)\s*E\.v\.?$", " e.V."), (r"(?i)Kg\b", "KG"), (r"(?i)Ug\b", "UG"),
)
EMPLOYER_OVERRIDES = {
    "My Humancapital GmbH": "My Humancapital", "Sumup": "SumUp", "Acemate.ai": "Acemate",
    "United Media": "United Media", "Matchingcompany®": "MatchingCompany", "Mammaly": "Mammaly",
    "Wolt - English": "Wolt", "Accenture": "Accenture",
    "Efly Marketplace Services GmbH": "Efly Marketplace Services", "Flix": "Flix",
    "Schwertfels Consulting GmbH": "Schwertfels Consulting", "Think About It GmbH": "Think About It",
    "Audius SE": "Audius", "Genossenschaftsverband Bayern e.V.": "Genossenschaftsverband Bayern",
    "Solaredge": "SolarEdge", "Automat-it": "Automat", "Intercon Solutions GmbH": "Intercon Solutions",
    "Prime Hr Agentur®": "Prime HR Agentur", "Remmert GmbH": "Remmert",
    "Wavestone Germany AG": "Wavestone Germany", "Hm Management Services GmbH": "HM Management Services",
    "Taxtalente.de": "Taxtalente", "Ventura Travel": "Ventura Travel",
}

# Presentation labels (ranked tables).
DISPLAY_LEGAL_FORMS = r"GmbH|AG|SE|Ltd\.?|Inc\.?|S\.A\.|S\.p\.A\.|PLC|LLC|B\.V\.|N\.V\.|KG|UG"
DISPLAY_TOKEN_CASE = ((r"\bGmbh\b", "GmbH"), (r"\bAg\b", "AG"), (r"\bSe\b", "SE"), (r"\bUk\b", "UK"),
                      (r"\bUsa\b", "USA"))
ROLE_DISPLAY_RULES = (
    (r"@.*$", ""),
    (r"(?i)\s*\(\s*[mfwd]\s*/\s*[mfwd]\s*/\s*[mfwd]\s*\)", ""),
    (r"(?i)\s*\([^)]*\ball\s+genders\b[^)]*\)", ""),
    (r"(?i)\bihk\b", ""),
    (r"(?i)^\(\s*Senior\s*\)\s*", "Senior "),
    (r"(?i)\(\s*Senior\s*\)(?=\S)", "Senior "),
    (r"(?i)^ausbildung\s+", ""),
    (r"(?i)fachinformatiker\*?in", "Fachinformatiker"),
    (r"(\w)\*([iI]n)\b", "$1"),
    (r"(?i)\s*-\s*Schwerpunkt\s+", " - "),
    (r"\s*[/\\]\s*", " / "),
    (r"\s*-\s*", " - "),
)
TABLE_TOP, CHART_TOP = 20, 12
TABLE_LABEL_MAX, CHART_LABEL_MAX, ROLE_LABEL_MAX = 88, 38, 100
