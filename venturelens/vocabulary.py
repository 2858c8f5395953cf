"""Word lists, patterns, page types, limits and text templates.

Results depend on these values being exactly what they are, so they stand here as
plain text, in natural order. Every operator takes them as arguments; these are defaults.
"""

from __future__ import annotations

# --- fixed values: page types -------------------------------------------------
PAGE_TYPES = [
    "homepage", "about", "product", "careers", "blog",
    "pricing", "customers", "partners", "press", "team",
]
CONTEXT_ORDER = [
    "homepage", "about", "product", "blog", "press",
    "careers", "pricing", "customers", "partners", "team",
]
SEED_PAGE_TYPE = "seed"
SNAPSHOT_PAGE_TYPES = ["about", "homepage", "team", "careers"]
CRAWL_PATHS = {
    "homepage": [""],
    "about": ["/about", "/about-us", "/company", "/who-we-are"],
    "product": ["/product", "/products", "/platform", "/solutions"],
    "careers": ["/careers", "/jobs", "/join-us"],
    "blog": ["/blog", "/news", "/insights", "/resources"],
    "pricing": ["/pricing", "/plans", "/buy", "/purchase"],
    "customers": ["/customers", "/case-studies", "/testimonials"],
    "partners": ["/partners", "/integrations", "/ecosystem"],
    "press": ["/press", "/newsroom", "/media"],
    "team": ["/team", "/leadership", "/founders"],
}

# --- fixed values: sentence keywords ------------------------------------------
FUNDING_WORDS = [
    "raised", "funding", "series", "round", "million", "billion", "investment", "valuation",
    "investors", "led by", "participated", "announced", "closed", "capital", "venture",
]
HEADCOUNT_WORDS = [
    "employees", "team members", "people", "staff", "workforce", "headcount", "joined",
    "growing team", "hiring",
]
LOCATION_WORDS = [
    "headquarters", "hq", "based in", "located in", "offices in", "presence in", "operates in",
    "founded in", "city", "country",
]
PRODUCT_WORDS = [
    "product", "platform", "solution", "service", "offering", "technology", "features",
    "capabilities", "tools",
]
CUSTOMER_WORDS = [
    "customer", "client", "used by", "trusted by", "partner", "case study", "success story",
    "enterprise",
]
LEADERSHIP_WORDS = [
    "ceo", "founder", "co-founder", "chief", "president", "vp", "vice president", "director",
    "head of", "leadership", "executive",
]

# --- fixed values: headcount and job patterns -----------------------------------
HEADCOUNT_PATTERNS = [
    r"team of (\d+)[\+\s]*(?:people|employees|members)?",
    r"(\d+)[\+\s]*(?:employee|people|team member|staff|person team)",
    r"staff of (\d+)",
    r"workforce of (\d+)",
    r"we are (\d+)[\+\s]*(?:people|employees)",
    r"grown to (\d+)[\+\s]*(?:people|employees)",
    r"(\d+)[\+\s]*person (?:team|company)",
]
HEADCOUNT_RANGE_PATTERNS = [
    r"(\d+)\s*[-–to]\s*(\d+)\s*(?:employee|people|team member)",
    r"between (\d+) and (\d+) (?:employee|people)",
]
JOB_COUNT_PATTERNS = [
    r"(\d+)\s*(?:open|available|current)?\s*(?:position|role|job|opening|career)",
    r"(\d+)\s*jobs?\s*(?:available|open)?",
    r"hiring for (\d+)\s*(?:position|role)",
    r"(\d+)\s*vacancies",
]
JOB_TITLE_PATTERNS = [
    r"(?:senior|junior|lead|principal|staff)?\s*(?:software|backend|frontend|full.?stack|ml|ai|data|product|sales|marketing|design|engineer|developer|manager|director|analyst|scientist)",
    r"(?:engineer|developer|manager|designer|analyst|scientist|specialist|coordinator|executive|associate)",
]
JOB_LIST_ITEM_PATTERN = (
    r"(?m)(?:^|\n)\s*[•\-\d+\.]\s+.*?"
    r"(?:engineer|developer|manager|designer|analyst|scientist|specialist)"
)
JOB_INDICATORS = [
    "apply now", "view job", "see position", "learn more", "apply for", "job description",
    "role:", "position:", "open role", "we're hiring", "join our team", "open position",
    "job opening", "career opportunity", "work with us",
]
DEPARTMENTS = {
    "engineering": ["engineer", "developer", "software", "technical", "backend", "frontend"],
    "sales": ["sales", "account executive", "business development"],
    "marketing": ["marketing", "growth", "content", "brand"],
    "product": ["product manager", "product designer"],
    "operations": ["operations", "ops", "support"],
    "data": ["data scientist", "data engineer", "analyst", "ml engineer"],
    "design": ["designer", "ux", "ui"],
}
CITIES = [
    "san francisco", "new york", "london", "paris", "tokyo", "singapore", "seattle", "austin",
    "boston", "chicago", "los angeles", "toronto", "berlin", "amsterdam", "bangalore", "mumbai",
    "sydney", "dublin",
]
# Lead-in words in any case, the place name itself case-sensitive (an all-insensitive form
# would swallow the words that follow the name).
OFFICE_PATTERNS = [
    r"(?i:(?:office|located|based) (?:in|at)) ([A-Z][a-z]+(?:,?\s+[A-Z][a-z]+)*)",
    r"(?i:headquarters in) ([A-Z][a-z]+(?:,?\s+[A-Z][a-z]+)*)",
]
REMOTE_POLICIES = {
    "Remote-first": ["remote-first", "fully remote", "remote only"],
    "Hybrid": ["hybrid", "flexible", "remote and office"],
    "In-office": ["in-office", "on-site", "office-based"],
}

# --- fixed values: link classes and list extraction -----------------------------
LINK_RULES = {
    "careers": ["career", "jobs", "join", "hiring", "work with"],
    "blog": ["blog", "insights", "news", "stories", "resources"],
    "press": ["press", "media", "newsroom"],
    "customers": ["customers", "case study", "case studies", "stories", "clients"],
    "partners": ["partner", "ecosystem", "integration", "alliance"],
    "pricing": ["pricing", "plans", "pricing plans", "buy"],
    "team": ["team", "leadership", "founder", "people"],
    "about": ["about", "company", "mission", "who we are"],
    "product": ["product", "platform", "solution"],
}
NETWORK_HOST = "linkedin.com"
NETWORK_COMPANY_PATH = "linkedin.com/company/"
LIST_SITE_HOST = "forbes.com"
HEADING_STOP_WORDS = [
    "under", "over", "top", "college", "universities", "best", "subscribe", "forbes", "menu",
    "sign in", "follow", "share",
]
LINK_STOP_WORDS = ["forbes", "subscribe", "sign in", "menu"]
LINE_STOP_WORDS = ["forbes", "subscribe", "sign in"]
PROFILE_PATHS = ["/companies/", "/profile/"]
HQ_PATTERNS = [
    r"(?i)headquarters?[:\s]+([^,\n]+),\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
    r"(?i)based in ([^,\n]+),\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
    r"(?i)located in ([^,\n]+),\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
]
FOUNDED_PATTERNS = [
    r"(?i)founded[:\s]+(\d{4})",
    r"(?i)established[:\s]+(\d{4})",
    r"(?i)founded in (\d{4})",
]
CATEGORY_WORDS = [
    "artificial intelligence", "machine learning", "generative ai", "llm", "nlp",
    "computer vision", "robotics", "autonomous", "data analytics", "mlops", "enterprise ai",
    "healthcare ai", "fintech", "saas", "cybersecurity",
]
REPO_URL_PATTERN = r"https?://(?:www\.)?github\.com/([a-zA-Z0-9_-]+(?:/[a-zA-Z0-9_.-]+)?)"
REPO_HOST = "github.com"

# --- fixed values: seed enrichment ---------------------------------------------
NAME_SUFFIX_PATTERN = r"\s+(ai|labs|inc|corp|llc)$"
SECTOR_RULES = {
    "Healthcare AI": ["doctor", "medical", "health", "clinical"],
    "Large Language Models": ["model developer", "llm", "language model"],
    "AI Coding": ["coding", "development", "developer"],
    "Video AI": ["video", "image editing"],
    "Sales AI": ["go-to-market", "sales"],
    "Computer Vision": ["vision", "image"],
    "Translation": ["translation", "language"],
    "Voice AI": ["voice", "speech", "audio"],
    "Robotics": ["robot", "humanoid"],
    "Data Analytics": ["analytics", "data storage"],
    "Enterprise Search": ["search engine", "enterprise"],
    "Legal AI": ["legal", "contract"],
    "Finance AI": ["finance", "fintech"],
    "Customer Service AI": ["customer service", "support"],
    "Music AI": ["music", "sound"],
    "AI Infrastructure": ["infrastructure", "cloud", "chipmaker"],
}
DEFAULT_SECTOR = "Artificial Intelligence"

# --- fixed values: records and dashboards ---------------------------------------
EVENT_TYPES = [
    "funding", "mna", "product_release", "integration", "partnership", "customer_win",
    "leadership_change", "regulatory", "security_incident", "pricing_change", "layoff",
    "hiring_spike", "office_open", "office_close", "benchmark", "open_source_release",
    "contract_award", "other",
]
SCHEMA_VERSION = "2.0.0"
NOT_DISCLOSED = "Not disclosed"
TRACTION_TYPES = ["partnership", "product_release", "leadership_change"]
RISK_TYPES = ["layoff", "leadership_change", "regulatory", "security_incident", "pricing_change"]
SECTIONS = [
    "## Company Overview",
    "## Business Model and GTM",
    "## Funding & Investor Profile",
    "## Growth Momentum",
    "## Visibility & Market Sentiment",
    "## Risks and Challenges",
    "## Outlook",
    "## Disclosure Gaps",
]
PROVENANCE_POLICY = (
    "Use only the sources you scraped. If a field is missing, write 'Not disclosed.' "
    "Do not infer valuation."
)
QUERY_TEMPLATES = [
    "%s company overview business model mission",
    "%s funding investors valuation capital",
    "%s growth hiring team employees",
    "%s product technology AI platform",
    "%s customers market visibility news",
]
CONTEXT_RULE = "\n\n---\n\n"
NO_CONTEXT = "No context available. Use 'Not disclosed.' for all fields."
RUBRIC = {"factual": 3, "schema": 2, "provenance": 2, "hallucination": 2, "readability": 1}

# --- fixed values: limits --------------------------------------------------------
CONTEXT_CAP = 30_000
MIN_FILE_CHARS = 100
CHUNK_SIZE = 800
CHUNK_OVERLAP = 200
CHUNK_SEPARATORS = ["\n\n", "\n", ". ", " ", ""]
HEADCOUNT_MIN, HEADCOUNT_MAX = 5, 100_000
JOBS_MIN, JOBS_MAX, JOBS_CAP = 1, 500, 200

# --- fixed values: company name without blanks and dots -> its domain ----------------
KNOWN_DOMAINS = {
    "openai": "openai.com",
    "anthropic": "anthropic.com",
    "huggingface": "huggingface.co",
    "cohere": "cohere.com",
    "midjourney": "midjourney.com",
    "mistralai": "mistral.ai",
    "perplexityai": "perplexity.ai",
    "runwayml": "runwayml.com",
    "elevenlabs": "elevenlabs.io",
    "databricks": "databricks.com",
    "scaleai": "scale.com",
    "glean": "glean.com",
    "notion": "notion.so",
    "deepl": "deepl.com",
    "abridge": "abridge.com",
    "anysphere": "cursor.sh",
    "baseten": "baseten.co",
    "captions": "captions.ai",
    "clay": "clay.com",
    "coactiveai": "coactive.ai",
    "crusoe": "crusoeenergy.com",
    "decagon": "decagon.ai",
    "figureai": "figure.ai",
    "fireworksai": "fireworks.ai",
    "harvey": "harvey.ai",
    "hebbia": "hebbia.ai",
    "lambda": "lambdalabs.com",
    "langchain": "langchain.com",
    "luminance": "luminance.com",
    "mercor": "mercor.com",
    "openevidence": "openevidence.com",
    "photoroom": "photoroom.com",
    "pika": "pika.art",
    "sakanaai": "sakana.ai",
    "sambanova": "sambanova.ai",
    "sierra": "sierra.ai",
    "skildai": "skild.ai",
    "snorkelai": "snorkel.ai",
    "speak": "speak.com",
    "stackblitz": "stackblitz.com",
    "suno": "suno.ai",
    "synthesia": "synthesia.io",
    "thinkingmachinelabs": "thinkingmachinelabs.com",
    "togetherai": "together.ai",
    "vannevarlabs": "vannevarlabs.com",
    "vastdata": "vastdata.com",
    "windsurf": "codeium.com/windsurf",
    "worldlabs": "worldlabs.ai",
    "writer": "writer.com",
    "xai": "x.ai",
}

# --- fixed values: text selection by page type -----------------------------------------
# Characters to keep, keyword picks (label, word list, sentences), and whether the kept characters stand before
# the picks (``both``) or only replace missing ones.
PAGE_RULES: dict[str, dict] = {
    "homepage": {"cut": 2500},
    "about": {"cut": 3500, "both": True, "picks": [("Locations: ", "location", 5), ("Leadership: ", "leadership", 10)]},
    "blog": {"cut": 2000, "picks": [("", "funding", 8)]},
    "press": {"cut": 2000, "picks": [("", "funding", 10)]},
    "careers": {"cut": 1500, "picks": [("Headcount info: ", "headcount", 5), ("Locations: ", "location", 5)]},
    "product": {"cut": 4000, "picks": [("", "product", 15)]},
    "pricing": {"cut": 4000},
    "customers": {"cut": 2000, "picks": [("", "customer", 10)]},
    "partners": {"cut": 2000},
    "team": {"cut": 4000, "picks": [("", "leadership", 20)]},
}
OTHER_PAGE_RULE = {"cut": 2000}

# --- fixed values: what marks a list item, in the order in which the rules are tried ----------------------
# (tag or None, attribute, value, how: the whole attribute, one of its words, or a part of it)
LIST_ITEM_RULES = [
    (None, "data-type", "list-item", "whole"),
    (None, "class", "fbs-list__item", "word"),
    (None, "class", "listitem", "word"),
    (None, "class", "ranked-list-item", "word"),
    ("div", "class", "list-item", "part"),
    ("div", "class", "company", "part"),
    ("article", "class", "company", "part"),
]
NAME_TAGS = ["h2", "h3", "h4", "a", "span"]
HEADING_TAGS = ["h2", "h3", "h4", "div", "span"]

# --- fixed values: repositories looked up where only an owner is known; {owner} stands for it --------------
REPO_GUESSES = ["{owner}", "{owner}.github.io", "transformers", "platform", "core"]

# --- fixed values: wording of the dashboard -----------------------------------------------
OUTLOOK_END = (
    ". Based on available structured fields, the company appears to have a clear product "
    "focus and defined buyer profile."
)
NO_FUNDING = "- No funding events disclosed"
NO_RECENT_FUNDING = "- No recent funding events disclosed"
NO_GAPS = "- None noted"
GAP_RAISED = "- Total raised not disclosed"
GAP_VALUATION = "- Valuation not disclosed"
GAP_RATING = "- Glassdoor rating unavailable or behind login"
GAP_PRICING = "- Pricing tiers not publicly detailed"
GAP_CUSTOMERS = "- Named customers not publicly listed"
VISIBILITY_LABELS = {
    "News Mentions (30d)": "news_mentions_30d",
    "Avg Sentiment": "avg_sentiment",
    "GitHub Stars": "github_stars",
    "Glassdoor Rating": "glassdoor_rating",
    "Attention Trend": "attention_trend",
}
