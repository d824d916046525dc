"""Dictionaries that drive location parsing and enrichment.

Everything under the FIXED VALUES banner must equal the values the original
pipeline ships with, because results (state detection order, tie-breaks
between families, the skill list) depend on them verbatim. Order matters:
state names are searched in table order and the first family / industry with
the best score wins, so every mapping here is an ordered tuple of pairs.

Users can replace the three taxonomies with their own YAML files
(``load_taxonomy``), exactly like the seed files of the original tool.
"""

from __future__ import annotations

from pathlib import Path

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline exactly; keep in this order)
# ---------------------------------------------------------------------------

# US states: two-letter code and full name, 50 states + DC, in table order.
US_STATES: tuple[tuple[str, str], ...] = (
    ("AL", "Alabama"),
    ("AK", "Alaska"),
    ("AZ", "Arizona"),
    ("AR", "Arkansas"),
    ("CA", "California"),
    ("CO", "Colorado"),
    ("CT", "Connecticut"),
    ("DE", "Delaware"),
    ("FL", "Florida"),
    ("GA", "Georgia"),
    ("HI", "Hawaii"),
    ("ID", "Idaho"),
    ("IL", "Illinois"),
    ("IN", "Indiana"),
    ("IA", "Iowa"),
    ("KS", "Kansas"),
    ("KY", "Kentucky"),
    ("LA", "Louisiana"),
    ("ME", "Maine"),
    ("MD", "Maryland"),
    ("MA", "Massachusetts"),
    ("MI", "Michigan"),
    ("MN", "Minnesota"),
    ("MS", "Mississippi"),
    ("MO", "Missouri"),
    ("MT", "Montana"),
    ("NE", "Nebraska"),
    ("NV", "Nevada"),
    ("NH", "New Hampshire"),
    ("NJ", "New Jersey"),
    ("NM", "New Mexico"),
    ("NY", "New York"),
    ("NC", "North Carolina"),
    ("ND", "North Dakota"),
    ("OH", "Ohio"),
    ("OK", "Oklahoma"),
    ("OR", "Oregon"),
    ("PA", "Pennsylvania"),
    ("RI", "Rhode Island"),
    ("SC", "South Carolina"),
    ("SD", "South Dakota"),
    ("TN", "Tennessee"),
    ("TX", "Texas"),
    ("UT", "Utah"),
    ("VT", "Vermont"),
    ("VA", "Virginia"),
    ("WA", "Washington"),
    ("WV", "West Virginia"),
    ("WI", "Wisconsin"),
    ("WY", "Wyoming"),
    ("DC", "District of Columbia"),
)

# Lower-case substrings that flag a remote posting.
REMOTE_KEYWORDS: tuple[str, ...] = (
    "remote",
    "work from home",
    "wfh",
    "anywhere",
    "distributed",
    "virtual",
)

# Lower-case substrings that mark a location as US when no state is found.
US_PHRASES: tuple[str, ...] = ("united states", "usa", "u.s.")

# Location parse confidences.
CONF_STATE = 0.9
CONF_US_PHRASE = 0.7
CONF_LENIENT = 0.3
STRICT_MIN_CONFIDENCE = 0.7

# Role families (seed taxonomy file), family -> keywords.
ROLE_FAMILIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Tech/Engineering", (
        "software engineer", "engineer", "developer", "architect", "sre",
        "devops", "backend", "frontend", "full stack", "fullstack",
        "infrastructure", "security engineer", "cloud engineer",
        "platform engineer", "systems engineer",
    )),
    ("Data/AI", (
        "data scientist", "data engineer", "data analyst", "machine learning",
        "ml engineer", "ai engineer", "analytics", "business intelligence",
        "bi analyst", "research scientist", "applied scientist",
    )),
    ("Product/Design", (
        "product manager", "product owner", "designer", "ux", "ui",
        "product designer", "design lead", "design manager",
        "user experience", "user research",
    )),
    ("Sales", (
        "sales", "account executive", "business development", "bdr", "sdr",
        "sales rep", "account manager", "sales manager", "enterprise sales",
    )),
    ("Marketing", (
        "marketing", "growth", "content", "social media", "brand",
        "demand generation", "digital marketing", "marketing manager",
        "product marketing", "performance marketing",
    )),
    ("Customer Success", (
        "customer success", "customer support", "support engineer",
        "solutions engineer", "technical account manager", "implementation",
        "onboarding",
    )),
    ("Finance", (
        "finance", "accounting", "controller", "accountant",
        "financial analyst", "fp&a", "treasurer", "cfo",
    )),
    ("HR/Talent", (
        "recruiter", "talent", "hr", "human resources", "people ops",
        "people partner", "talent acquisition", "sourcer",
    )),
    ("Operations/Strategy", (
        "operations", "strategy", "program manager", "project manager",
        "business ops", "chief of staff", "operations manager", "biz ops",
    )),
    ("Legal/Compliance", (
        "legal", "counsel", "lawyer", "compliance", "paralegal", "attorney",
        "general counsel", "privacy",
    )),
)

# Industries (seed mapping file), industry -> keywords.
INDUSTRIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Technology", (
        "software", "saas", "cloud", "ai", "artificial intelligence",
        "machine learning", "data", "tech", "platform", "api", "developer",
        "infrastructure",
    )),
    ("Financial Services", (
        "fintech", "banking", "finance", "investment", "trading", "payments",
        "credit", "lending", "wealth", "insurance",
    )),
    ("Healthcare", (
        "health", "medical", "healthcare", "biotech", "pharma", "clinical",
        "patient", "hospital", "therapy", "diagnostics",
    )),
    ("E-commerce/Retail", (
        "ecommerce", "e-commerce", "retail", "marketplace", "shopping",
        "consumer", "brands", "direct-to-consumer", "d2c",
    )),
    ("Media/Entertainment", (
        "media", "entertainment", "gaming", "streaming", "content",
        "publishing", "video", "music", "creator",
    )),
    ("Education", (
        "education", "edtech", "learning", "university", "school", "training",
        "tutoring", "curriculum",
    )),
    ("Real Estate", (
        "real estate", "proptech", "property", "housing", "construction",
        "mortgage", "rental",
    )),
    ("Transportation/Logistics", (
        "transportation", "logistics", "delivery", "shipping", "supply chain",
        "mobility", "freight", "fleet",
    )),
    ("Energy", (
        "energy", "renewable", "solar", "climate", "sustainability",
        "utilities", "cleantech", "carbon",
    )),
    ("Professional Services", (
        "consulting", "legal", "accounting", "advisory",
        "professional services", "law", "audit",
    )),
    ("Cybersecurity", (
        "cybersecurity", "security", "infosec", "compliance", "privacy",
        "threat", "vulnerability",
    )),
)

# Skills (seed skills file), category -> skills, matched as whole words.
SKILLS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("programming_languages", (
        "Python", "JavaScript", "TypeScript", "Java", "C++", "C#", "Go",
        "Rust", "Ruby", "PHP", "Swift", "Kotlin", "Scala", "R", "SQL", "Bash",
        "Shell",
    )),
    ("cloud_platforms", (
        "AWS", "Azure", "GCP", "Google Cloud", "Kubernetes", "Docker",
        "Terraform", "CloudFormation", "EKS", "ECS", "Lambda",
    )),
    ("data_engineering", (
        "Spark", "Hadoop", "Airflow", "dbt", "Snowflake", "BigQuery",
        "Redshift", "Databricks", "Kafka", "Flink", "Fivetran", "Airbyte",
    )),
    ("ml_ai", (
        "TensorFlow", "PyTorch", "scikit-learn", "Keras", "LangChain",
        "Hugging Face", "OpenAI", "LLM", "GPT", "Computer Vision", "NLP",
        "BERT", "Transformers",
    )),
    ("databases", (
        "PostgreSQL", "MySQL", "MongoDB", "Redis", "Cassandra", "DynamoDB",
        "Elasticsearch", "Neo4j",
    )),
    ("bi_tools", (
        "Tableau", "Power BI", "Looker", "Qlik", "Metabase", "Mode",
        "Sisense",
    )),
    ("sales_tools", (
        "Salesforce", "HubSpot", "Outreach", "SalesLoft", "Gong", "Apollo",
        "ZoomInfo",
    )),
    ("collaboration", (
        "Slack", "Jira", "Confluence", "Notion", "Asana", "Monday", "Linear",
    )),
    ("web_frameworks", (
        "React", "Angular", "Vue", "Django", "Flask", "FastAPI", "Spring",
        "Rails", "Node.js", "Express", "Next.js", ".NET",
    )),
    ("methodologies", (
        "Agile", "Scrum", "Kanban", "CI/CD", "DevOps", "TDD", "Microservices",
    )),
)

# Scoring weights.
ROLE_TITLE_WEIGHT = 10
ROLE_DESC_WEIGHT = 1
INDUSTRY_NAME_WEIGHT = 5
INDUSTRY_DOMAIN_WEIGHT = 5
INDUSTRY_DESC_WEIGHT = 1
INDUSTRY_DESC_CHARS = 1000
INDUSTRY_CONFIDENCE_DIVISOR = 10.0

# Board URL conventions.
GREENHOUSE_HOST = "boards.greenhouse.io"
LEVER_HOST = "lever.co"
GREENHOUSE_DEFAULT_JOB_URL = "https://boards.greenhouse.io/jobs/"
LEVER_DEFAULT_JOB_URL = "https://jobs.lever.co/"
URL_PATTERN_CONFIDENCE = 0.95
PROBE_CONFIDENCE = 0.85

REJECT_NOT_US = "Failed US location validation"
COUNTRY = "US"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

Taxonomy = tuple[tuple[str, tuple[str, ...]], ...]


def flatten(taxonomy: Taxonomy) -> list[str]:
    """Keywords of all categories, in file order (categories then keywords)."""
    return [k for _, words in taxonomy for k in words]


def load_taxonomy(path: str | Path, key: str, default: Taxonomy) -> Taxonomy:
    """Read ``{key: {category: [keywords]}}`` from YAML, keeping file order.

    A missing file or a missing key gives ``default``, as the seed loaders of
    the original tool do. Loading happens once on the driver; the result is
    baked into the plan as literals, so nothing is read per row. Without a
    YAML parser the import error is raised: a user's file is never ignored.
    """
    p = Path(path)
    if not p.exists():
        return default
    import yaml

    with open(p, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    mapping = data.get(key)
    if not isinstance(mapping, dict):
        return default
    return tuple((str(c), tuple(str(k) for k in (ks or ()))) for c, ks in mapping.items())
