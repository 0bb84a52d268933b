"""Rule lists. All are defaults of function arguments, so a domain can bring its own."""

# --- Fixed values: results depend on these exact lists, patterns and labels. ---

UNHELPFUL_PHRASES = [
    "I don't have enough information",
    "I don't have access",
    "I don't have specific information",
    "I'm not able to provide specific information",
    "I'm unable to retrieve information",
    "Invalid Input",
    "cannot find any specific information",
    "couldn't find specific information",
    "having difficulty accessing",
    "wasn't able to find",
    "I'm unable to access your specific",
    "I don't have direct access",
    "I cannot directly retrieve",
    "Our system detected a potentially unhelpful response",
    "An error has occurred while generating a response",
    "Sorry, I'm not fluent in all languages yet",
    "Something went wrong on my end, and I'm not sure what caused it",
]

PROFANITY_PATTERNS = [
    r"\bf+u+c+k+\w*\b",
    r"\bs+h+i+t+\w*\b",
    r"\ba+s+s+h+o+l+e+\w*\b",
    r"\bb+i+t+c+h+\w*\b",
    r"\bd+a+m+n+\w*\b",
    r"\bc+u+n+t+\w*\b",
    r"\bd+i+c+k+\w*\b",
    r"\bb+a+s+t+a+r+d+\w*\b",
    r"\bi+d+i+o+t+\w*\b",
    r"\bwtf\b",
    r"\bstfu\b",
    r"\bf[\*\.\-_]+c?k\w*\b",
    r"\bs[\*\.\-_]+h[\*\.\-_]*t\w*\b",
]
PROFANITY_LABEL = "[REDACTED]"

# label -> (pattern, ignore case), in the order they were first published.
PII_PATTERNS = {
    "EMAIL": (
        r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\."
        r"(?:com|org|net|edu|gov|co|io|dev|info|biz)(?:\.[a-z]{2,3})?(?=\s|[^a-zA-Z]|$)",
        True,
    ),
    "PHONE": (r"(\+?\d{1,3}[-.\s]?)?\(?\d{2,4}\)?[-.\s]?\d{3,4}[-.\s]?\d{3,4}", False),
    "PRODUCT_ID": (r"\bB[0-9A-Z]{9}\b", False),
    "CARD": (r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{1,7}\b", False),
    "ACCOUNT": (r"\b\d{8,17}\b", False),
    "SSN": (r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b", False),
    "ORDER_ID": (r"\b\d{3}-\d{7}-\d{7}\b", False),
    "URL": (r"https?://\S+", False),
    "IP": (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", False),
    "AMOUNT": (r"\$[\d,]+\.?\d*", False),
    "ADDRESS": (
        r"\b\d{1,5}\s+[A-Za-z]+\s+"
        r"(St|Street|Ave|Avenue|Blvd|Boulevard|Dr|Drive|Rd|Road|Ln|Lane|Way|Ct|Court|Pl|Place)\b",
        True,
    ),
    "NAME": (r"\b(Mr|Mrs|Ms|Dr|Miss)\.?\s+[A-Z][a-z]+(\s+[A-Z][a-z]+)?", False),
}

LANGUAGES = [
    "English", "Chinese", "German", "Japanese", "Hindi",
    "Dutch", "Spanish", "Italian", "Portuguese", "Turkish",
    "Korean", "Arabic", "Vietnamese", "French",
]

HINGLISH_WORDS = [
    "nahi", "hai", "kya", "kaise", "karna", "karo", "mera", "meri", "mere",
    "hua", "hoga", "kaha", "woh", "yeh", "bhi", "aur", "lekin", "kyunki",
    "agar", "toh", "par", "sab", "kuch", "bahut", "accha", "theek", "haan",
    "naa", "matlab", "samajh", "batao", "bata", "dikha", "dikhao", "milega",
    "chahiye", "karke", "wala", "wali", "raha", "rahi", "gaya", "gayi",
    "pehle", "baad", "upar", "neeche", "andar", "bahar", "sath",
]

# Alternatives of one pattern, in order.
LANGUAGE_NOISE = [
    r"https?://\S+", r"\[\[.*?\]\]", r"\[.*?\]\(.*?\)", r"\*+", r"#+", r"\\n", r"\n",
    r"[{}()\[\]|`~<>]", r"\bB[0-9A-Z]{9}\b", r"\b[A-Z0-9]{10,}\b", r"\b\d{3}-\d{7}-\d{7}\b",
    r"[€$£¥₹][\d.,]+", r"[\d.,]+[€$£¥₹]", r"\b[A-Z][A-Z0-9_]{5,}\b", r"\S+@\S+\.\S+",
    r"\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",
]
KNOWN_LETTERS = (
    "[a-zA-Z\u00c0-\u024f\u0400-\u04ff\u4e00-\u9fff"
    "\u3040-\u30ff\u0600-\u06ff\u0900-\u097f\uac00-\ud7af]{2,}"
)
HAN = "[\u4e00-\u9fff]"
KANA = "[\u3040-\u30ff]"
HANGUL = "[\uac00-\ud7af]"
ARABIC = "[\u0600-\u06ff]"
DEVANAGARI = "[\u0900-\u097f]"
TURKISH_LETTERS = "[ışğİŞĞ]"
GERMAN_LETTERS = "[äöüßÄÖÜ]"

NEGATIVE_SIGNALS = [
    "negative", "frustrated", "frustration", "dissatisfied",
    "unhappy", "angry", "upset", "disappointed", "annoyed",
    "irritated", "unresolved", "not satisfied", "displeased",
]

# Lengths, in characters.
PROMPT_CHARS = 8000
FALLBACK_CHARS = 4000
SUMMARY_CHARS = 1000
KEYWORDS_CHARS = 500
ERROR_CHARS = 200
LANGUAGE_CHARS = 200

# Model settings of the first and the second attempt.
FIRST_SETTINGS = {"max_tokens": 250, "temperature": 0.2, "top_p": 0.9}
FALLBACK_SETTINGS = {"max_tokens": 200, "temperature": 0.1, "top_p": 0.9}
MAX_ATTEMPTS = 5

# --- End of fixed values. ---

# Specific shapes first: a 16-digit card must not be taken for a phone number plus rest.
SPECIFIC_FIRST = [
    "EMAIL", "URL", "IP", "ORDER_ID", "CARD", "SSN",
    "PRODUCT_ID", "AMOUNT", "ACCOUNT", "PHONE", "ADDRESS", "NAME",
]
SHIPPED = list(PII_PATTERNS)
REDACTION_ORDERS = {"specific_first": SPECIFIC_FIRST, "shipped": SHIPPED}

# What Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ISO code -> language name, for labelled training text.
LANGUAGE_CODES = {
    "en": "English", "zh": "Chinese", "de": "German", "ja": "Japanese", "hi": "Hindi",
    "nl": "Dutch", "es": "Spanish", "it": "Italian", "pt": "Portuguese", "tr": "Turkish",
    "ko": "Korean", "ar": "Arabic", "vi": "Vietnamese", "fr": "French",
}

POSITIVE_WORDS = [
    "thanks", "thank", "great", "perfect", "excellent", "wonderful", "awesome",
    "helpful", "solved", "resolved", "works", "happy", "love", "good",
]
NEGATIVE_WORDS = [
    "angry", "useless", "terrible", "awful", "frustrated", "frustrating", "disappointed",
    "annoyed", "wrong", "broken", "unresolved", "worst", "worthless", "ridiculous", "bad",
]
STOP_WORDS = [
    "that", "this", "with", "have", "from", "your", "will", "would", "there", "their",
    "what", "when", "which", "where", "been", "were", "they", "them", "then", "than",
    "some", "into", "also", "here", "just", "about", "please", "could", "should",
]

PROMPT_TEMPLATE = (
    "You analyse conversations between a User and a Bot.\n"
    "Rules:\n"
    "- Leave out personal data of any kind: names, contact data, identifiers, links, addresses, money.\n"
    "- Leave out offensive wording.\n"
    "- Name topics in general terms; for sensitive content give the intent only.\n\n"
    "The turns below are in order of time. Give three fields:\n"
    "1. SUMMARY: at most 150 words on the flow: first request, answers, change of topic, outcome.\n"
    "2. SENTIMENT: one of Positive, Negative, Neutral, judged from the User's messages only; "
    "signals are open issues, repeated attempts, terse replies and frustration.\n"
    "3. KEYWORDS: 3 to 8 topics taken from the Bot's answers.\n\n"
    "Answer in this form:\n"
    "SUMMARY: <text>\n"
    "SENTIMENT: <Positive, Negative or Neutral>\n"
    "KEYWORDS: <topic, topic, ...>\n\n"
    "Conversation:\n"
)
FALLBACK_TEMPLATE = (
    "Describe this conversation in two or three sentences: its topic, and whether the user "
    "ended satisfied, frustrated or neutral.\n"
    "Answer in this form:\n"
    "SUMMARY: <text>\n"
    "SENTIMENT: <Positive, Negative or Neutral>\n\n"
)
