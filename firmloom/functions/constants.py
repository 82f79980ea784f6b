"""Word lists, patterns and numbers the results depend on.

They are given, not designed; changing any of them changes results.
"""

# --- URL normalisation -------------------------------------------------------
STARTER_TRACKING_PARAMS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid", "ref", "ref_src",
)
TRACKING_PARAMS = STARTER_TRACKING_PARAMS + ("srsltid",)
# Schemes that carry an authority, as in Python's urllib.parse.
NETLOC_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp",
    "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
    "git+ssh", "ws", "wss", "itms-services",
)
# Schemes whose references resolve against a base, as in Python's urllib.parse.
RELATIVE_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero",
    "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
SEARCH_BLOCKED_PREFIXES = {
    "google": (
        "https://www.google.", "http://www.google.",
        "https://webcache.googleusercontent.", "https://googleads.g.doubleclick.net/",
    ),
    "duckduckgo": ("https://duckduckgo.com/",),
}
DIRECTORY_DOMAINS = (
    "wikipedia.org", "linkedin.com", "facebook.com", "instagram.com", "youtube.com", "glassdoor.com",
    "indeed.com", "ambitionbox.com", "crunchbase.com", "justdial.com", "carwale.com",
)

# --- frontier scoring --------------------------------------------------------
HIGH_VALUE_HINTS = (
    "/about", "/about-us", "/company", "/contact", "/contact-us", "/team", "/leadership", "/locations",
)
LOW_VALUE_HINTS = ("/privacy", "/terms", "/login", "/signin", "/cart", "/checkout")
BROWSER_HINTS = ("login", "signup", "account", "dashboard", "app.")
IMPORTANT_SOURCE_TYPES = {
    "important_contact_page": ("/contact", "/contact-us", "/reach-us", "/locations"),
    "important_about_page": ("/about", "/about-us", "/company", "/overview"),
    "important_leadership_page": ("/leadership", "/management", "/team", "/board"),
}
SIGNAL_WEIGHTS = {
    "source_quality": 0.30, "entity_likelihood": 0.25, "freshness_urgency": 0.20, "path_value": 0.15,
    "link_context_score": 0.10, "host_risk_score": -0.20, "crawl_cost": -0.10, "depth": -0.05,
}

# --- page extraction ---------------------------------------------------------
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
META_DESCRIPTION_PATTERN = r"""(?is)<meta[^>]+name=["']description["'][^>]+content=["'](.*?)["']"""
EMAIL_PATTERN = r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PAGE_PHONE_PATTERN = r"(?U)\+?\d[\d\-\s()]{7,}\d"
ADDRESS_PATTERN = (
    r"(?iU)\b\d{1,5}\s+[A-Za-z0-9.,\-\s]{5,80}"
    r"(?:road|rd|street|st|avenue|ave|lane|ln|nagar|floor|tower|park|plaza|sector|phase)\b"
)
# The same three as SQL engines read them: digits, blanks and the ends of words are ASCII; letters match in either case,
# and with them the long s and the Kelvin sign.
_ASCII_EDGE = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"
_S, _K = r"[s\u017f]", r"[k\u212a]"
ASCII_EMAIL_PATTERN = (
    rf"(?i){_ASCII_EDGE}[A-Z\u017f\u212a0-9._%+-]+@[A-Z\u017f\u212a0-9.-]+\.[A-Z\u017f\u212a]{{2,}}{_ASCII_EDGE}"
)
ASCII_PAGE_PHONE_PATTERN = r"\+?[0-9][0-9\-\t\n\f\r ()]{7,}[0-9]"
ASCII_ADDRESS_PATTERN = (
    rf"(?i){_ASCII_EDGE}[0-9]{{1,5}}[\t\n\f\r ]+[A-Z\u017f\u212a0-9.,\-\t\n\f\r ]{{5,80}}"
    rf"(?:road|rd|{_S}treet|{_S}t|avenue|ave|lane|ln|nagar|floor|tower|par{_K}|plaza|{_S}ector|pha{_S}e){_ASCII_EDGE}"
)
JSON_LD_PATTERN = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
PAGE_SOCIAL_DOMAINS = ("linkedin.com", "facebook.com", "instagram.com", "x.com", "twitter.com", "youtube.com")
PAGE_TYPE_HINTS = {
    "about": ("/about", "/about-us", "/company", "/who-we-are", "/overview"),
    "contact": ("/contact", "/contact-us", "/reach-us", "/locations"),
    "leadership": ("/leadership", "/management", "/team", "/board"),
    "careers": ("/careers", "/jobs", "/join-us"),
}
PAGE_TYPE_PRIORITY = {"contact": 4, "about": 3, "leadership": 2, "careers": 1, "generic": 0}
PAGE_TYPE_WEIGHTS = {"contact": 1.0, "about": 0.9, "leadership": 0.75, "careers": 0.55, "generic": 0.35}
COMPANY_NODE_TYPES = ("Organization", "Corporation", "LocalBusiness")

# --- company profile ---------------------------------------------------------
PROFILE_SOCIAL_DOMAINS = PAGE_SOCIAL_DOMAINS + ("tiktok.com",)
PROFILE_PAGE_HINTS = {
    "about": ("/about", "/about-us", "/company", "/overview", "/who-we-are"),
    "contact": ("/contact", "/contact-us", "/support", "/reach-us", "/locations"),
    "careers": ("/careers", "/jobs", "/join-us", "/work-with-us"),
    "leadership": ("/leadership", "/management", "/team", "/board"),
}
GENERIC_COMPANY_NAMES = (
    "contact us", "leadership", "overview", "news & stories", "innovation", "our businesses",
    "sign in", "home", "homepage", "welcome",
)
GENERIC_NAME_PHRASES = (" careers", " jobs", "join us", "with you", "& you", "welcome to", "sign in")
GENERIC_NAME_PREFIXES = ("from ", "our ", "welcome ", "discover ", "explore ")
GENERIC_SOCIAL_PATHS = (
    "", "login", "signup", "jobs", "games", "feed", "home", "top-content", "pub", "dir", "search", "hashtag",
)
SOCIAL_ACTION_FRAGMENTS = ("/share", "/intent/", "/sharer", "/search?", "/hashtag/")
STRICT_EMAIL_PATTERN = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
TEXT_PHONE_PATTERN = r"(?U)\+?\d[\d\-\s()]{6,}\d"
# The look-ahead on the first letter changes no match; it spares most positions the alternatives.
LABELED_PHONE_PATTERNS = (
    r"(?iU)(?=[ptmc])(?:phone|tel|telephone|mobile|call us|contact)\s*[:\-]?\s*(\+?\d[\d\-\s()]{6,}\d)",
    r"(?iU)(?=[bsh])(?:board|switchboard|helpline|hotline)\s*[:\-]?\s*(\+?\d[\d\-\s()]{6,}\d)",
)
LOCATION_PATTERNS = (
    r"(?iU)\bheadquarters(?:ed)?\s+(?:in|at)\s+([A-Z][A-Za-z0-9&.,\-\s]{2,80})",
    r"(?iU)\bbased\s+in\s+([A-Z][A-Za-z0-9&.,\-\s]{2,80})",
    r"(?iU)\blocated\s+in\s+([A-Z][A-Za-z0-9&.,\-\s]{2,80})",
    r"(?iU)\bcorporate office\s*[:\-]?\s*([A-Z][A-Za-z0-9&.,\-\s]{2,80})",
)
NON_LOCATION_WORDS = ("businesses", "solutions", "products", "services")

# --- company intake ----------------------------------------------------------
ORG_HINTS = (
    "private limited", "pvt ltd", "limited", "llp", "transport", "roadways", "travels", "cargo",
    "logistics", "packers", "movers", "express", "enterprise", "enterprises", "solutions",
    "corporation", "corp", "agency", "associates",
)
BOOKING_NOISE = ("online tickets booking", "ticket booking", "booking", "online booking")
BLOCK_SIGNALS = (
    "captcha", "recaptcha", "sorry", "forbidden", "access denied", "blocked", "verify you are human",
    "unusual traffic", "temporarily unavailable", "sign in", "robot",
)
