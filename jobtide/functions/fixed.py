"""Lookup tables, word lists and patterns that results depend on.

Everything here is data, kept as plain text. Rules that use it live in the
sibling modules.
"""

# US state name -> postal code.
US_STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR",
    "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID",
    "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS",
    "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS",
    "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK",
    "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT",
    "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
}

# City short form -> city name.
CITY_ALIASES = {
    "sf": "San Francisco", "la": "Los Angeles", "nyc": "New York City",
    "ny": "New York", "dc": "Washington", "philly": "Philadelphia",
    "chi": "Chicago", "atl": "Atlanta", "sea": "Seattle", "den": "Denver",
    "bos": "Boston", "sfo": "San Francisco", "lax": "Los Angeles",
}

# Title word -> expansion.
TITLE_WORDS = {
    "sr": "Senior", "sr.": "Senior", "jr": "Junior", "jr.": "Junior",
    "mgr": "Manager", "eng": "Engineer", "engr": "Engineer", "dev": "Developer",
    "swe": "Software Engineer", "sde": "Software Development Engineer",
    "pm": "Product Manager", "tpm": "Technical Program Manager",
    "em": "Engineering Manager", "vp": "Vice President",
    "svp": "Senior Vice President", "evp": "Executive Vice President",
    "cto": "Chief Technology Officer", "cio": "Chief Information Officer",
    "ceo": "Chief Executive Officer", "cfo": "Chief Financial Officer",
    "ml": "Machine Learning", "ai": "AI", "ui": "UI", "ux": "UX", "qa": "QA",
    "ops": "Operations", "devops": "DevOps", "sre": "Site Reliability Engineer",
    "dba": "Database Administrator", "sysadmin": "System Administrator",
}

# Words kept in capitals.
ACRONYMS = ["UI", "UX", "AI", "ML", "API", "SDK", "QA", "DevOps", "SRE",
            "AWS", "GCP", "iOS", "SQL", "NoSQL", "ETL", "CI", "CD"]

# Company endings, removed in this order.
COMPANY_ENDINGS = [
    ", inc.", ", inc", " inc.", " inc",
    ", llc", " llc",
    ", ltd", " ltd", ", limited", " limited",
    ", corp.", ", corp", " corp.", " corp", ", corporation", " corporation",
    ", co.", ", co", " co.", " co",
    ", plc", " plc",
    ", gmbh", " gmbh",
    ", ag", " ag",
    ", sa", " sa",
    ", pty", " pty",
]

# Currency code or sign -> US dollars.
CURRENCY_RATES = {
    "USD": 1.0, "$": 1.0, "EUR": 1.10, "€": 1.10, "GBP": 1.27, "£": 1.27,
    "CAD": 0.74, "C$": 0.74, "AUD": 0.66, "A$": 0.66, "CHF": 1.12,
    "JPY": 0.0067, "¥": 0.0067, "INR": 0.012, "₹": 0.012,
}

# Marks of a pay period, looked for in this order, and the
# number of such periods in a year.
PERIOD_MARKS = [
    ("hourly", ["hour", "hr", "/h"], 2080),
    ("daily", ["day", "/d"], 260),
    ("weekly", ["week", "/w", "wk"], 52),
    ("monthly", ["month", "/m", "mo"], 12),
    ("yearly", ["year", "annual", "/y", "yr"], 1),
]

# Keywords per experience level, strongest level first.
LEVEL_KEYWORDS = {
    "intern": ["intern", "internship", "co-op", "coop", "summer", "fall intern",
               "spring intern", "winter intern"],
    "executive": ["director", "vp", "vice president", "cto", "cio", "chief",
                  "head of engineering", "head of", "executive",
                  "15+ years", "20+ years"],
    "principal": ["principal", "principal engineer", "level vii", "level 7", "l7",
                  "distinguished", "fellow"],
    "staff": ["staff", "staff engineer", "level vi", "level 6", "l6",
              "10+ years", "12+ years"],
    "lead": ["lead", "tech lead", "team lead", "manager", "engineering manager",
             "development manager", "level v", "level 5", "l5",
             "8+ years", "10+ years", "7-10 years", "8-12 years"],
    "senior": ["senior", "sr", "sr.", "experienced", "level iv", "level 4", "l4",
               "iv", "advanced", "5+ years", "5-7 years", "5-8 years",
               "6+ years", "7+ years", "5-10 years", "8+ years"],
    "mid": ["mid", "mid-level", "intermediate", "level ii", "level 2", "level iii",
            "level 3", "l2", "l3", "ii", "iii", "2-5 years", "3-5 years",
            "2-4 years", "3-6 years", "4-6 years", "2+ years", "3+ years",
            "4+ years"],
    "entry": ["junior", "jr", "jr.", "entry", "entry-level", "associate", "graduate",
              "new grad", "new-grad", "recent grad", "college grad",
              "university grad", "apprentice", "trainee", "early career",
              "early-career", "no experience required", "no experience needed",
              "will train", "0-1 years", "0-2 years", "1-2 years",
              "up to 2 years", "entry level", "level i", "level 1", "l1",
              "i ", "ii "],
}

# Keywords per job type and per remote type.
JOB_TYPE_KEYWORDS = {
    "internship": ["internship", "intern", "co-op", "coop"],
    "contract": ["contract", "contractor", "consulting", "freelance", "c2c", "c2h",
                 "corp-to-corp"],
    "temporary": ["temporary", "temp", "seasonal"],
    "part-time": ["part-time", "part time", "parttime", "half-time"],
    "full-time": ["full-time", "full time", "fulltime", "permanent", "fte"],
}
JOB_TYPE_HINT_ORDER = ["internship", "contract", "part-time", "full-time"]
REMOTE_KEYWORDS = {
    "hybrid": ["hybrid", "flexible", "partial remote", "some remote"],
    "remote": ["remote", "work from home", "wfh", "telecommute", "distributed",
               "anywhere"],
    "onsite": ["onsite", "on-site", "in-office", "in office", "office-based",
               "on premises"],
}

# Patterns that name the years of experience.
YEARS_PATTERNS = [
    r"(\d+)\+?\s*(?:years?|yrs?)(?:\s+of)?\s+(?:experience|exp)",
    r"(\d+)\s*-\s*\d+\s*(?:years?|yrs?)(?:\s+of)?\s+(?:experience|exp)",
    r"minimum\s+(?:of\s+)?(\d+)\s*(?:years?|yrs?)",
    r"at\s+least\s+(\d+)\s*(?:years?|yrs?)",
    r"(\d+)\s*(?:years?|yrs?)\s+(?:minimum|min)",
    r"experience:\s*(\d+)\+?\s*(?:years?|yrs?)",
]

# Words of the word-bounded entry-level rule.
STRICT_NEGATIVE = ["senior", "head", "sr", "staff", "lead", "manager", "principal",
                   "expert", "vp", "director", "chief", "phd"]

# Query parameters dropped from URLs before matching.
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term",
                   "utm_content", "ref", "source", "fbclid", "gclid"]

# HTML entities decoded, in this order.
HTML_ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
                 ("&quot;", '"')]

# Endings ignored when two company aliases are compared.
ALIAS_ENDINGS = ["ai", "io", "co", "inc", "com", "net", "ltd", "llc", "app", "labs",
                 "tech", "group", "space", "global", "network", "systems", "limited",
                 "security", "software", "techteam", "partners", "corporation",
                 "engineering", "technologies"]

# Phrases that make a title relevant to machine learning work.
RELEVANT_PHRASES = [
    "ai", "artificial intelligence", "ml", "machine learning", "data science",
    "data scientist", "data engineer", "nlp", "natural language processing",
    "computer vision", "deep learning", "ai engineer", "ai agent engineer",
    "ai agent", "agentic ai engineer", "ai researcher", "research engineer",
    "mlops", "machine learning engineer", "ml engineer", "senior ml engineer",
    "staff ml engineer", "principal ml engineer", "ai software engineer",
    "ml infrastructure engineer", "mlops engineer", "deep learning engineer",
    "computer vision engineer", "nlp engineer", "speech recognition engineer",
    "reinforcement learning engineer", "ai research scientist",
    "machine learning researcher", "research scientist", "applied scientist",
    "principal researcher", "generative ai engineer", "rag engineer",
    "retrieval-augmented generation developer", "rag pipeline engineer",
    "ai agent developer", "gpu machine learning engineer", "cuda engineer",
    "performance engineer", "deep learning compiler engineer", "gpgpu engineer",
    "ml acceleration engineer", "ai hardware engineer", "cuda libraries engineer",
    "tensorrt engineer", "ai solutions architect", "ai architect",
    "ai platform architect", "agentic",
]

# Job type code -> names in several languages, spaces and hyphens removed.
JOB_TYPE_SYNONYMS = {
    "fulltime": ["fulltime", "períodointegral", "estágio/trainee", "cunormăîntreagă",
                 "tiempocompleto", "vollzeit", "voltijds", "tempointegral", "全职",
                 "plnýúvazek", "fuldtid", "دوامكامل", "kokopäivätyö", "tempsplein",
                 "πλήρηςαπασχόληση", "teljesmunkaidő", "tempopieno", "heltid",
                 "jornadacompleta", "pełnyetat", "정규직", "100%", "全職", "งานประจำ",
                 "tamzamanlı", "повназайнятість", "toànthờigian"],
    "parttime": ["parttime", "teilzeit", "částečnýúvazek", "deltid"],
    "contract": ["contract", "contractor"],
    "temporary": ["temporary"],
    "internship": ["internship", "prácticas", "ojt(onthejobtraining)", "praktikum",
                   "praktik"],
    "perdiem": ["perdiem"],
    "nights": ["nights"],
    "other": ["other"],
    "summer": ["summer"],
    "volunteer": ["volunteer"],
}

# Free job type word -> code used by the application tracker.
TRACKER_JOB_TYPES = {
    "fulltime": "fulltime", "full": "fulltime", "permanent": "fulltime",
    "parttime": "parttime", "part": "parttime", "contract": "contract",
    "contractor": "contract", "internship": "internship", "intern": "internship",
    "temporary": "temporary", "temp": "temporary",
}

# Country names; a list entry gives the names of one country,
# the first is the one displayed.
COUNTRIES = [
    ["argentina"], ["australia"], ["austria"], ["bahrain"], ["bangladesh"],
    ["belgium"], ["bulgaria"], ["brazil"], ["canada"], ["chile"], ["china"],
    ["colombia"], ["costa rica"], ["croatia"], ["cyprus"],
    ["czech republic", "czechia"], ["denmark"], ["ecuador"], ["egypt"], ["estonia"],
    ["finland"], ["france"], ["germany"], ["greece"], ["hong kong"], ["hungary"],
    ["india"], ["indonesia"], ["ireland"], ["israel"], ["italy"], ["japan"],
    ["kuwait"], ["latvia"], ["lithuania"], ["luxembourg"], ["malaysia"], ["malta"],
    ["mexico"], ["morocco"], ["netherlands"], ["new zealand"], ["nigeria"],
    ["norway"], ["oman"], ["pakistan"], ["panama"], ["peru"], ["philippines"],
    ["poland"], ["portugal"], ["qatar"], ["romania"], ["saudi arabia"],
    ["singapore"], ["slovakia"], ["slovenia"], ["south africa"], ["south korea"],
    ["spain"], ["sweden"], ["switzerland"], ["taiwan"], ["thailand"],
    ["türkiye", "turkey"], ["ukraine"], ["united arab emirates"],
    ["uk", "united kingdom"], ["usa", "us", "united states"], ["uruguay"],
    ["venezuela"], ["vietnam"],
]

# Tracker statuses of the master list and those that remove a row.
MASTER_STATUSES = ["UNKNOWN", "NEW", "ARCHIVE", "INTERVIEWING", "INTERVIEWED",
                   "REJECTED", "ACCEPTED", "DELETE", "INTERESTED", "APPLIED", "APPLY",
                   "OLD"]
MASTER_REMOVE_STATUSES = ["DELETE", "ARCHIVE", "REJECTED", "OLD"]
MASTER_LOCALES = ["CANADA_ENGLISH", "CANADA_FRENCH", "USA_ENGLISH", "UK_ENGLISH",
                  "FRANCE_FRENCH", "GERMANY_GERMAN"]
MASTER_REMOTENESS = ["UNKNOWN", "IN_PERSON", "TEMPORARILY_REMOTE", "PARTIALLY_REMOTE",
                     "FULLY_REMOTE", "ANY"]
MASTER_COLUMNS = ["status", "title", "company", "location", "date", "blurb", "tags",
                  "link", "id", "provider", "query", "locale", "wage", "remoteness"]

# Column order of the merged multi-site table.
SITE_COLUMNS = [
    "id", "site", "job_url", "job_url_direct", "title", "company", "location",
    "date_posted", "job_type", "salary_source", "interval", "min_amount",
    "max_amount", "currency", "is_remote", "job_level", "job_function",
    "listing_type", "emails", "description", "company_industry", "company_url",
    "company_logo", "company_url_direct", "company_addresses",
    "company_num_employees", "company_revenue", "company_description", "skills",
    "experience_range", "company_rating", "company_reviews_count", "vacancy_count",
    "work_from_home_type",
]

# Export column order.
EXPORT_COLUMNS = ["id", "title", "company", "location", "url", "job_type",
                  "experience_level", "remote_type", "salary_min", "salary_max",
                  "salary_currency", "first_seen_at", "last_seen_at", "is_active"]
EXPORT_SOURCE_COLUMNS = ["source_name", "source_type", "compliance_status"]
EXPORT_KEY_COLUMNS = ["external_id", "content_hash"]

# Where a board's postings live.
BOARD_URLS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/{company}",
    "lever": "https://api.lever.co/v0/postings/{company}",
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/{company}",
    "amazon_jobs": "https://www.amazon.jobs/en/search",
}
DEFAULT_BOARD_URL = "https://{company}.com/careers"

# Employee bands that count as large enough.
LARGE_COMPANY_BANDS = ["10K+", "5K-10K", "1K-5K", "501-1K", "201-500", "51-200"]

# English stop words of a common text search configuration.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was",
    "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the",
    "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out",
    "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should", "now",
]

# Salary ranges as they are written: in dollars, in thousands, with a currency code, with an interval by size, in lakhs.
DOLLAR_RANGE = r"(?i)\$\s*([\d,]+)\s*(k)?\s*[-–to]+\s*\$?\s*([\d,]+)\s*(k)?\s*(?:per\s+)?(year|annual|month|hour|hr)?"
THOUSANDS_RANGE = r"(?i)\$\s*([\d.]+)\s*(k)\s*[-–to]+\s*\$?\s*([\d.]+)\s*(k)"
CODED_RANGE = r"(?i)([\d,]+)\s*[-–to]+\s*([\d,]+)\s*(USD|EUR|GBP|CAD)"
INTERVAL_RANGE = r"\$(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)\s*[-—–]\s*(?:\$)?(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)"
LAKH_RANGE = r"(?i)^(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)\s*(Lacs|Lakh|Cr)\s*(P\.A\.)?"
