"""Patterns, weights and names that results depend on. Plain, in their order of precedence."""

# Content type by URL; the first match counts.
URL_TYPES = [
    (r"arxiv\.org/(abs|pdf|html)/\d", "research_paper"),
    (r"aclanthology\.org/\d{4}\.\w+-\w+", "research_paper"),
    (r"openreview\.net/forum", "research_paper"),
    (r"semanticscholar\.org/paper", "research_paper"),
    (r"ncbi\.nlm\.nih\.gov/(pmc|pubmed)", "research_paper"),
    (r"github\.com/[^/]+/[^/]+/(blob|tree)/", "source_code"),
    (r"github\.com/[^/]+/[^/]+/?$", "source_code"),
    (r"\.(py|rs|go|c|cpp|h|ts|js|java|rb|swift|zig|lua|ml|hs)$", "source_code"),
    (r"readthedocs\.(io|org)", "technical_doc"),
    (r"docs\.(python|rust-lang|golang|pytorch|tensorflow|numpy)\.", "technical_doc"),
    (r"developer\.mozilla\.org", "technical_doc"),
    (r"wikipedia\.org/wiki/", "encyclopedia"),
    (r"stackoverflow\.com/questions/\d", "technical_qa"),
    (r"stackexchange\.com/questions/\d", "technical_qa"),
    (r"distill\.pub", "research_paper"),
    (r"paulgraham\.com", "long_form_essay"),
    (r"(huggingface|lilianweng)", "research_blog"),
    (r"(medium|substack)\.com", "blog_post"),
    (r"(reddit|news\.ycombinator)\.com", "forum_post"),
    (r"(twitter|instagram|tiktok|facebook)\.com", "social_media"),
]

# Content type by text: pattern, whether case is ignored, type, least matches per word.
TEXT_TYPES = [
    (r"\b(abstract|introduction|related work|methodology|conclusion|references)\b", True, "research_paper", 0.003),
    (r"\b(def |class |fn |impl |func |function |#include|import |from .+ import)\b", False, "source_code", 0.005),
    (r"\b(theorem|lemma|proof|corollary|proposition)\b", True, "research_paper", 0.002),
    (r"\b(dataset|benchmark|baseline|ablation|evaluation|epoch|batch_size)\b", True, "research_paper", 0.004),
    (r"\bparameters?\b.*\bmodel\b|\bmodel\b.*\bparameters?\b", True, "research_paper", 0.002),
]

# What raises or lowers a page's signal score; (pattern, whether case is ignored).
SIGNAL_REWARDS = [
    (r"\bfigure \d+\b", True),
    (r"\b(theorem|lemma|proof|corollary|proposition)\b", True),
    (r"\b(algorithm|complexity|O\(n\))\b", True),
    (r"\b(dataset|experiment|baseline|benchmark|ablation)\b", True),
    (r"\b(def |class |fn |impl |func )\b", False),
    (r"\breferences?\b", True),
    (r"\b(section|subsection|appendix)\s+\d", True),
    (r"\b(loss|gradient|backprop|optimizer|epoch|batch)\b", True),
    (r"\b(precision|recall|F1|accuracy|BLEU|ROUGE|perplexity)\b", True),
    (r"\b(assert|unittest|pytest|test_)\b", False),
    (r"\b(API|REST|endpoint|schema|interface)\b", True),
    (r"[A-Z][a-z]+\s+et\s+al\.", True),
    (r"\d{4}\.\d{4,5}", False),
]
SIGNAL_PENALTIES = [
    (r"click here", True),
    (r"sign up (now|today|free)", True),
    (r"limited time offer", True),
    (r"subscribe (now|to our newsletter)", True),
    (r"\bcookie policy\b", True),
    (r"\baffiliate\b", True),
    (r"\bsponsored\b", True),
    (r"all rights reserved", True),
    (r"\bprivacy policy\b", True),
    (r"(buy now|add to cart|checkout)", True),
    (r"[^\w\s]{8,}", False),
    (r"(\b\w+\b)( \1){4,}", True),
]

# A page's signal score by the type of its URL.
SIGNAL_BASE = {
    "research_paper": 0.9, "source_code": 0.85, "technical_doc": 0.8, "encyclopedia": 0.7, "technical_qa": 0.7, "research_blog": 0.7,
    "long_form_essay": 0.65, "technical_blog": 0.6, "blog_post": 0.45, "forum_post": 0.3, "social_media": 0.05, "unknown": 0.4,
}

# Code language by the end of a URL's path.
CODE_LANGUAGES = {
    ".py": "python", ".rs": "rust", ".go": "go", ".c": "c", ".h": "c", ".cpp": "cpp", ".cc": "cpp", ".cxx": "cpp", ".ts": "typescript", ".js": "javascript",
    ".java": "java", ".rb": "ruby", ".swift": "swift", ".zig": "zig", ".lua": "lua", ".ml": "ocaml", ".hs": "haskell", ".jl": "julia", ".r": "r",
    ".sql": "sql", ".sh": "bash", ".bash": "bash",
}

# Words of which two make a text of unknown type one of this type.
TYPE_KEYWORDS = [
    (["abstract", "introduction", "methodology", "conclusion", "references", "theorem", "lemma"], "research_paper"),
    (["def ", "class ", "fn ", "impl ", "function ", "#include", "import ", "from . import"], "source_code"),
    (["parameters", "returns", "example usage", "api reference", "install", "pip install"], "technical_doc"),
    (["dataset", "benchmark", "experiment", "evaluation", "accuracy", "f1 score"], "research_paper"),
    (["chapter ", "section ", "textbook", "exercise ", "problem set"], "textbook"),
    (["press release", "breaking news", "reported", "journalist"], "news_article"),
]

# Weights of domains (first match), content types and code languages.
DOMAIN_WEIGHTS = [
    ("*.github.com", 1.15, "github"), ("github.com", 1.15, "github"), ("*.arxiv.org", 1.25, "arxiv"), ("arxiv.org", 1.25, "arxiv"),
    ("*.huggingface.co", 1.10, "huggingface"), ("huggingface.co", 1.10, "huggingface"), ("*", 1.00, "web"),
]
TYPE_WEIGHTS = {
    "research_paper": 1.25, "source_code": 1.15, "technical_doc": 1.10, "technical_qa": 1.00, "encyclopedia": 1.00, "research_blog": 0.95,
    "long_form_essay": 0.90, "technical_blog": 0.90, "blog_post": 0.80, "forum_post": 0.65, "social_media": 0.20, "unknown": 0.80,
}
CODE_WEIGHTS = {
    "python": 1.05, "rust": 1.05, "go": 1.05, "cpp": 1.05, "c": 1.00, "typescript": 1.00, "javascript": 0.95, "java": 0.95, "ruby": 0.90, "swift": 0.90,
    "zig": 1.00, "lua": 0.85, "ocaml": 1.00, "haskell": 1.00, "julia": 1.00, "r": 0.90, "sql": 0.95, "bash": 0.95, "unknown": 1.00,
}

# What raises or lowers the quality score, and its bounds. Case is ignored.
QUALITY_REWARDS = [
    r"\b(figure \d+)\b", r"\b(theorem|lemma|proof|corollary|proposition)\b", r"\b(algorithm|complexity|O\(n\))\b",
    r"\b(dataset|experiment|baseline|benchmark|ablation)\b", r"\b(def |class |fn |impl |func )\b", r"\breferences?\b",
    r"\b(section|subsection|appendix)\s+\d", r"\b(loss|gradient|backprop|optimizer|epoch|batch)\b",
    r"\b(precision|recall|F1|accuracy|BLEU|ROUGE|perplexity)\b", r"\b(assert|unittest|pytest|test_)\b", r"\b(API|REST|endpoint|schema|interface)\b",
]
QUALITY_PENALTIES = [
    r"click here", r"sign up (now|today|free)", r"limited time offer", r"subscribe (now|to our newsletter)", r"\bcookie policy\b", r"\baffiliate\b",
    r"\bsponsored\b", r"all rights reserved", r"\bprivacy policy\b", r"(buy now|add to cart|checkout)",
]
QUALITY_BOUNDS = {"words": (50, 100_000), "word_length": (3.5, 12.0), "unique": 0.20, "digits": 0.30, "letters": 0.60}

# Exclusion tags and their patterns; case is ignored and a dot matches a newline.
EXCLUSIONS = {
    "general-news": [r"\bbreaking news\b", r"\btop stories\b"],
    "marketing": [r"\bbuy now\b", r"\badd to cart\b", r"\bsubscribe now\b", r"\bsponsored content\b"],
    "entertainment": [r"\b(?:movie|film|tv|television) review\b", r"\bcelebrity gossip\b", r"\b(?:music|gaming) news\b"],
    "offensive-instructions": [r"\bexploit payload\b", r"\bcredential dumping\b", r"\bmalware deployment\b"],
    "investment-advice": [r"\bnot financial advice\b", r"\bshould you buy\b", r"\bprice target\b"],
    "financial-advice": [r"\bnot financial advice\b", r"\bshould you buy\b", r"\bprice target\b"],
    "medical-advice": [r"\bdiagnose you\b", r"\byou should take\b.*\bmedication\b", r"\bprescribe\b.*\bmedication\b"],
    "personal-medical-diagnosis": [r"\byour symptoms mean\b", r"\byou have \b.*\bdiagnosis\b"],
    "treatment-prescription": [r"\bprescribe\b", r"\bchange your medication\b"],
    "personal-legal-advice": [r"\byou should sue\b", r"\byou should plead guilty\b", r"\bthis is legal advice\b"],
    "political-persuasion": [r"\bvote for\b", r"\bvote against\b", r"\bsupport this candidate\b"],
    "unsupported-climate-claims": [r"\bclimate change is a hoax\b", r"\bscientists proved climate change is fake\b"],
    "unsupported-health-claims": [
        r"\bmiracle cure\b", r"\bdetox(?:es|ify|ification)?\b.*\bcure\b", r"\bcures? cancer\b", r"\bvaccines? (?:cause|causes) (?:autism|infertility)\b",
    ],
    "unverified-claims": [r"\bunverified claim\b", r"\bunverified claims\b", r"\bunconfirmed report\b", r"\bunconfirmed reports\b"],
    "sensational-content": [r"\bshocking revelation\b", r"\byou won't believe\b", r"\bexplosive new details\b"],
    "low-quality-social-content": [r"\bviral post\b", r"\bshare this now\b"],
}

# Keys that name a source beyond doubt; licence states that count as known.
IDENTITY_KEYS = {
    "github": ["full_name", "commit_sha"], "arxiv": ["arxiv_id", "version"], "huggingface": ["repo", "revision", "split", "row_index"], "google": ["result_url", "query"],
}
SOURCE_KINDS = ["web", "github", "arxiv", "huggingface", "google"]
KNOWN_RIGHTS = ["verified", "permissive", "approved"]

# Elements that an HTML page's text leaves out, for cleaning and for parsing.
CLEAN_DROPPED = ["script", "style", "nav", "footer", "aside", "header", "form", "noscript", "iframe"]
PARSE_DROPPED = ["script", "style", "noscript", "nav", "footer", "aside", "form", "iframe", "a"]
