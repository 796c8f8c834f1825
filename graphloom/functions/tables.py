"""Word lists and lookup tables whose entries decide results. Every function that uses one takes another."""

# Runs of capitals and how they are written in names.
ABBREVIATIONS = {
    "ID": "Id", "API": "Api", "URL": "Url", "URI": "Uri", "HTTP": "Http", "HTTPS": "Https", "PSD2": "Psd2", "IBAN": "Iban", "BIC": "Bic", "SEPA": "Sepa", "TPP": "Tpp", "ASPSP": "Aspsp",
    "AIS": "Ais", "PIS": "Pis", "PIIS": "Piis", "SCA": "Sca", "PSU": "Psu", "XML": "Xml", "JSON": "Json", "DTO": "Dto", "SPI": "Spi", "CMS": "Cms", "DB": "Db",
}
# Role suffixes of Java class names, in the order in which they are tried.
JAVA_SUFFIXES = ("ServiceImpl", "RepositoryImpl", "RestController", "Controller", "Service", "Repository", "Impl", "Facade", "Adapter", "Factory", "Handler", "Provider", "Manager")
# Names of parsers, and of HTTP methods.
JAVA_PARSERS = ("java_parser", "java", "spring_parser")
OPENAPI_PARSERS = ("openapi_parser", "openapi", "yaml_parser")
HTTP_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE", "HEAD", "OPTIONS")
# Words that keep their final s.
NOT_PLURAL = ("access", "address", "process", "status", "class", "alias", "basis")
# Names of one concept.
SYNONYMS = {
    "PaymentInitiation": ["Payment", "PaymentController", "InitiatePayment", "PaymentService", "PostPayments", "PostPayment", "PaymentRequest", "PaymentInitiationService", "PaymentInitiation"],
    "AccountInformation": ["Account", "AccountController", "AccountInformationService", "GetAccounts", "GetAccount", "AccountService", "AccountInformation"],
    "ConsentManagement": ["Consent", "ConsentController", "ConsentService", "ConsentManagementService", "CreateConsent", "PostConsents", "ConsentManagement"],
    "FundsConfirmation": ["Funds", "FundsController", "FundsConfirmationService", "CheckFunds", "FundsConfirmation"],
    "TransactionHistory": ["Transaction", "TransactionController", "GetTransactions", "TransactionService", "TransactionHistory"],
}
# Canonical entity types.
TYPES = {
    "class": "domain_entity", "controller": "api_component", "restcontroller": "api_component", "service": "service_component", "repository": "data_component", "entity": "domain_entity",
    "interface": "domain_entity", "component": "service_component", "field": "attribute", "method": "operation", "endpoint": "api_operation", "schema": "api_schema", "property": "attribute",
    "concept": "concept", "payment_type": "domain_entity", "account_type": "domain_entity", "regulation": "concept", "role": "concept", "action": "operation", "domain_entity": "domain_entity",
    "api_component": "api_component", "service_component": "service_component", "data_component": "data_component", "api_operation": "api_operation", "api_schema": "api_schema",
    "attribute": "attribute", "operation": "operation",
}
TYPE_FALLBACK = "concept"
# Canonical relationship types.
RELATIONS = {
    "CALLS": "USES", "USES": "USES", "DEPENDS_ON": "DEPENDS_ON", "DEPENDS": "DEPENDS_ON", "DEPENDSON": "DEPENDS_ON", "REFERENCES": "REFERENCES", "REFERENCE": "REFERENCES", "RETURNS": "EXPOSES",
    "ACCEPTS": "USES", "IMPLEMENTS": "IMPLEMENTS", "EXTENDS": "IMPLEMENTS", "DOCUMENTS": "DOCUMENTS", "DOCUMENTED_BY": "DOCUMENTS", "EXPOSES": "EXPOSES",
}
RELATION_FALLBACK = "REFERENCES"
# Names that a domain holds to be equal.
DOMAINS = {
    "PaymentRequest": ["PaymentDTO", "PaymentRequest", "Payment Initiation Request"],
    "AccountRequest": ["AccountDTO", "AccountRequest", "Account Information Request"],
    "ConsentRequest": ["ConsentDTO", "ConsentRequest", "Consent Management Request"],
}
# Terms that are found in texts.
VOCABULARY = {"Payment": ["payment", "payments"], "Account": ["account", "accounts"], "Consent": ["consent", "consents"], "Customer": ["customer", "customers"], "Transaction": ["transaction", "transactions"]}
VOCABULARY_LABEL = "DOMAIN_ENTITY"
# Versions in texts, the most specific rule first; \\b and \\d are Unicode, case is ignored where (?i) stands.
CONTENT_VERSIONS = (
    ("psd2", r"(?i)\bPSD2\s+[Vv]?(\d+(?:\.\d+)+)"),
    ("berlin_group", r"(?i)Berlin\s+Group\s+[Vv]?(\d+(?:\.\d+)*)"),
    ("nextgenpsd2", r"(?i)NextGenPSD2\s+[Vv]?(\d+(?:\.\d+)*)"),
    ("openapi", r"(?i)openapi[:\s]+[Vv]?(\d+(?:\.\d+)+)"),
    ("version_prefix_semantic", r"\b[Vv](\d+\.\d+(?:\.\d+)*)\b"),
    ("version_prefix_major", r"\b[Vv](\d+)\b"),
    ("semantic_version", r"\b(\d+\.\d+(?:\.\d+)*)\b"),
)
# Versions in paths, in the order in which they are tried, with their numbers of groups.
PATH_VERSIONS = (
    (r"(?i)\bv(\d+(?:\.\d+)*)\b", 1),
    (r"_(\d+)_(\d+)(?:_(\d+))?(?:\b|_|$)", 3),
    (r"[-/](\d+)\.(\d+)(?:\.(\d+))?(?:\b|[-/_]|$)", 3),
    (r"\b(\d+)_(\d+)\b", 2),
)
# How addresses of other places begin, and how Markdown files end.
EXTERNAL_SCHEMES = ("http://", "https://", "ftp://", "ftps://", "mailto:", "tel:", "ssh://", "git://")
MARKDOWN_SUFFIXES = (".md", ".markdown", ".mdown", ".mkd")
# Endings that say nothing about a file, in the order in which they are taken off.
FILE_SUFFIXES = ("_clean", "_final", "_draft", "_v1", "_v2", "_v3")
# Acronyms in file names, categories by words in them, publishers, and lines of a text that are looked at.
FILE_ACRONYMS = ("api", "psd2", "ais", "pis", "xs2a", "http", "json", "xml")
FILE_CATEGORIES = (("implementation", "Implementation Guidelines"), ("guidelines", "Implementation Guidelines"), ("operational", "Operational Rules"), ("rules", "Operational Rules"), ("spec", "API Specification"), ("reference", "Reference Manual"), ("manual", "Reference Manual"))
ORGANISATIONS = ("Berlin Group", "NextGenPSD2", "STET", "Open Banking", "European Banking Authority", "EBA")
TITLE_LINES, VERSION_LINES, HEAD_LINES = 50, 20, 30
# What embedders call the types of entities.
INPUT_TYPES = {"class": "JAVA_CLASS", "method": "JAVA_METHOD", "endpoint": "API_ENDPOINT", "schema": "OPENAPI_SCHEMA", "section": "MARKDOWN_SECTION"}
# Versions, titles, publishers and dates in file names, heads of texts, link titles and paths, in the order in
# which they are tried.
FILE_VERSIONS = (r"(?i)_v?(\d+[._]\d+(?:[._]\d+)?)", r"(?i)v(\d+[._]\d+(?:[._]\d+)?)")
FILE_VERSION_PART = r"(?i)_v?\d+[._]\d+[._]?\d*"
HEAD_TITLE, TITLE_LINK = r"(?m)^[ \t]*# +(\S.*?)[ \t]*$", r"\[([^\]]+)\]\([^\)]+\)"
HEAD_VERSIONS = (r"[Vv]ersion[:\s]+(\d+\.\d+(?:\.\d+)?)", r"[Vv]\.?\s*(\d+\.\d+(?:\.\d+)?)", r"Release\s+(\d+\.\d+(?:\.\d+)?)")
HEAD_AUTHOR = r"[Bb]y\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
HEAD_DATES = (r"[Pp]ublished[:\s]+(\d{4}-\d{2}-\d{2})", r"[Pp]ublication [Dd]ate[:\s]+(\d{4}-\d{2}-\d{2})", r"[Dd]ate[:\s]+(\d{4}-\d{2}-\d{2})", r"(\d{2}/\d{2}/\d{4})", r"(\d{4}/\d{2}/\d{2})")
LINK_VERSION, TRAILING_VERSION, PART_VERSION = r"(?i)V(\d+\.\d+(?:\.\d+)*)", r"(\d+\.\d+(?:\.\d+)*)\s*$", r"(?U)\b(\d+\.\d+(?:\.\d+)*)\b"
