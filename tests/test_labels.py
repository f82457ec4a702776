import pytest
from pyspark.sql import functions as F

from vacancy_lake.functions import labels as L, rules as R

ROLES = [
    ("Senior Cyber Security Analyst", "cybersecurity"), ("IT-Security Engineer", "cybersecurity"),
    ("Data Engineer (m/w/d)", "data_analytics"), ("Power BI Berater", "data_analytics"), ("DA Developer", "data_analytics"),
    ("DevOps Engineer", "devops_cloud_infrastructure"), ("Cloud Engineer Java", "devops_cloud_infrastructure"),
    ("Customer Success Manager", "customer_success_support"), ("IT Support", "customer_success_support"),
    ("Softwareentwickler", "software_engineering"), ("Full-Stack Engineer", "software_engineering"),
    ("Product Owner", "product_program_project"), ("Scrum Master", "product_program_project"),
    ("SEO Manager", "marketing_content_growth"), ("Brand Lead", "marketing_content_growth"),
    ("Vertrieb Nord", "sales_business_development"), ("Key Account Lead", "sales_business_development"),
    ("Buchhaltung", "finance_accounting"), ("Tax Lead", "finance_accounting"),
    ("HR Partner", "hr_recruiting"), ("Recruiter", "hr_recruiting"), ("UX Lead", "design_creative"), ("Motion Design", "design_creative"),
    ("Paralegal", "legal_compliance"), ("Jurist", "legal_compliance"), ("FPGA Lead", "hardware_electronics_embedded"),
    ("Firmware Lead", "hardware_electronics_embedded"), ("Berater", "consulting"), ("Advisory Lead", "consulting"),
    ("Sekretärin", "operations_administration"), ("Supply Chain Lead", "operations_administration"),
    ("Gardener", "unknown_other"), ("", "unknown_other"), (None, "unknown_other"),
    ("Support Engineer Software", "customer_success_support"),  # fits two families: order decides
]


@pytest.mark.parametrize("title,family", ROLES)
def test_family(rows, title, family):
    assert rows([title], "v string", lambda: L.role_family(L.clean_role("v"))) == [family]


def test_family_rules_cover_fifteen_families():
    assert len({n for n, _ in R.ROLE_FAMILIES}) == 15


CLEAN = [
    ("Dev (m/w/d) (Remote)", "dev"), ("Dev all genders ref. nr: AB-12", "dev"), ("Dev Job ID #123", "dev"),
    ("-- Dev ;;", "dev"), ("Dev -- Ops", "dev ops"), ("(vor Ort)", ""), ("Dev stellennr. 77", "dev"),
]


def test_clean_role(rows):
    assert rows([c for c, _ in CLEAN], "v string", lambda: L.clean_role("v")) == [e for _, e in CLEAN]


EMPLOYERS = [
    ("acme gmbh", "acme"), ("the acme inc.", "acme"), ("acme co.", "acme"), ("gmbh", "gmbh"), ("acme, ag", "acme"),
    ("acme gmbh kg", "acme gmbh"), ("", R.UNKNOWN_EMPLOYER), (" - ", R.UNKNOWN_EMPLOYER), (None, R.UNKNOWN_EMPLOYER),
]


def test_employer_key(rows):
    assert rows([c for c, _ in EMPLOYERS], "v string", lambda: L.employer_key("v")) == [e for _, e in EMPLOYERS]


LABELS = [
    ("acme gmbh", "Acme GmbH"), ("acme se", "Acme SE"), ("acme ag", "Acme AG"), ("verein e.v.", "Verein e.V."),
    ("shop kg", "Shop KG"), ("shop ug", "Shop UG"), ("foo.ai", "Foo.ai"), ("foo.io", "Foo.io"), ("sumup", "SumUp"),
    ("audius se", "Audius"), ("matchingcompany®", "MatchingCompany"), (R.LONG_TAIL, R.LONG_TAIL_LABEL),
    (R.UNKNOWN_EMPLOYER, R.UNKNOWN_EMPLOYER_LABEL),
]


def test_employer_label(rows):
    assert rows([c for c, _ in LABELS], "v string", lambda: L.employer_label("v")) == [e for _, e in LABELS]
    assert len(R.EMPLOYER_OVERRIDES) == 23


DISPLAY = [
    ("company", "o'brien uk gmbh", "O'Brien UK"), ("company", "acme ag se", "Acme"), ("company", "3d world ltd.", "3D World"),
    ("location", "frankfurt am main", "Frankfurt Am Main"), ("skill", "ci/cd", "Ci/Cd"), ("skill", "", ""),
    ("role", "(senior) dev @ acme", "Senior Dev"), ("role", "ausbildung fachinformatiker*in", "Fachinformatiker"),
    ("role", "koch - schwerpunkt pasta", "Koch - Pasta"), ("role", "dev/ops-lead", "Dev / Ops - Lead"),
    ("role", "dev (all genders)", "Dev"), ("role", "lehrer*in (m/w/d)", "Lehrer"),
]


def test_display(rows):
    for kind, raw, expected in DISPLAY:
        assert rows([raw], "v string", lambda: L.display_label("v", kind)) == [expected], raw


def test_chart_labels_are_short(rows):
    long = "senior principal distinguished platform reliability engineer"
    got = rows([long], "v string", lambda: L.chart_label("v", "role"))[0]
    assert got == "Senior Principal Distinguished…"
    one = rows(["x" * 60], "v string", lambda: L.chart_label("v", "role"))[0]
    assert one == "X" + "x" * 36 + "…"
    place = rows(["abcde " * 10], "v string", lambda: L.chart_label("v", "location"))[0]
    assert len(place) == 38 and place.endswith("…")


def test_shorten(rows):
    assert rows(["a b", "abcdef"], "v string", lambda: L.shorten_hard(F.col("v"), 4)) == ["a b", "abc…"]
