"""Texts, lists, patterns and limits that decide the results."""

# --- Fixed values: personal-data patterns, in the order they are applied ---------
PII_TYPES = ["email", "phone", "ssn", "credit_card", "ip_address"]
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b(?:\+?1[-.]?)?(?:\(\d{3}\)|\d{3})[-.]?\d{3}[-.]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b\d{4}[\s\-]?\d{4}[\s\-]?\d{4}[\s\-]?\d{4}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
}
PII_TOKENS = {
    "email": "[EMAIL]",
    "phone": "[PHONE]",
    "ssn": "[SSN]",
    "credit_card": "[CREDIT_CARD]",
    "ip_address": "[IP_ADDRESS]",
}

# --- Fixed values: characters that separate words (Unicode white space plus the
# --- four ASCII separators), and what counts as a word character or a digit ------
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD_CLASS = r"\p{L}\p{N}_"
DIGIT_CLASS = r"\p{Nd}"

# --- Fixed values: quality scoring ----------------------------------------------
MIN_CHARS = 20
MAX_CHARS = 1000
LENGTH_PENALTY = 0.3
REPETITION_PENALTY = 0.2
LANGUAGE_PENALTY = 0.1
PLACEHOLDER_PENALTY = 0.5
REPETITION_LIMIT = 0.3
REPETITION_MIN_WORDS = 5
ASCII_LETTER_SHARE = 0.7
PLACEHOLDER = "[PLACEHOLDER]"
MIN_QUALITY = 0.6
DEDUP_THRESHOLD = 0.95
DEDUP_NGRAM = 2

# --- Fixed values: chat format --------------------------------------------------
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
SYSTEM_PROMPT = """You are an expert insurance support agent for a Turkish insurance company.

You help customers with:
- Policy inquiries and explanations
- Claims processing guidance
- Coverage questions
- Premium and billing information
- Policy modifications and renewals

Respond professionally, accurately, and within company policies. Always be helpful and clear."""
UNKNOWN_CATEGORY = "unknown"

# --- Fixed values: splits and preference seeds -----------------------------------
SPLIT_RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}
SPLIT_SEED = 42
PREFERENCE_SEEDS = {"train": 42, "validation": 43}

# --- Fixed values: rejected answers of preference pairs ---------------------------
REJECTED_ANSWERS = {
    "vague": "I'm not sure about that. You should check your policy documents or call us back later.",
    "missing_information": "Yes, that should be covered. Let me know if you have other questions.",
    "wrong_procedure": "Just send us an email about it and we'll figure it out eventually.",
    "unprofessional": "Look, I don't know the details of your policy off the top of my head. You'll need to check that yourself.",
    "overpromising": "Don't worry, everything is definitely covered under your policy. We'll take care of everything no matter what.",
    "too_short": "Please check your policy.",
    "generic": "Thank you for your question. Our policies vary and I would recommend reviewing your specific policy documentation for more details.",
    "redirect": "That's handled by a different department. You'll need to call them directly during business hours.",
}

# --- Fixed values: categories and the keywords expected in their answers ----------
CATEGORIES = [
    "policy_inquiry",
    "claim_processing",
    "coverage_questions",
    "premium_billing",
    "policy_modifications",
]
KEYWORDS = {
    "policy_inquiry": [
        "policy", "coverage", "deductible", "premium", "limit",
        "insured", "terms", "renewal", "benefit",
    ],
    "claim_processing": [
        "claim", "file", "submit", "document", "adjuster",
        "process", "approval", "status", "evidence",
    ],
    "coverage_questions": [
        "covered", "coverage", "protection", "exclude",
        "liability", "comprehensive", "collision", "benefit",
    ],
    "premium_billing": [
        "premium", "payment", "billing", "invoice", "due",
        "discount", "installment", "renewal", "rate",
    ],
    "policy_modifications": [
        "change", "modify", "update", "cancel", "add",
        "remove", "adjust", "transfer", "endorsement",
    ],
}
MIN_KEYWORDS = 2

# --- Fixed values: answer format checks ------------------------------------------
FORMAT_MIN_WORDS = 20
FORMAT_MAX_WORD_SHARE = 0.15
TONE_PHRASES = [
    "thank you", "i can", "happy to help", "assist",
    "let me", "please", "your policy", "your claim",
    "i understand", "certainly", "of course",
]
CLOSING_PHRASES = [
    "anything else", "further assistance", "don't hesitate",
    "contact us", "help you", "let me know", "questions",
]
PLACEHOLDER_PHRASES = ["[placeholder]", "[todo]", "[fill in]", "lorem ipsum"]

# --- Fixed values: constant answer of the generic baseline ------------------------
GENERIC_ANSWER = "I can help you with that. Please check your policy documents for more details."

# --- Fixed values: request for an outside model, by category ----------------------
REQUEST_SUBJECTS = {
    "policy_inquiry": "asking about their insurance policy details, coverage, deductible, or terms",
    "claim_processing": "filing an insurance claim, checking claim status, or asking about claim documents",
    "coverage_questions": "asking what is and isn't covered under their insurance policy",
    "premium_billing": "asking about premium payments, billing, discounts, or payment methods",
    "policy_modifications": "requesting changes to their policy like adding drivers, updating address, or canceling",
}
REQUEST_HEAD = "Generate a realistic customer support conversation between a customer and an insurance agent.\n\nThe customer is "
REQUEST_TAIL = ".\n\nFormat EXACTLY as:\nUSER: [one specific customer question]\nAGENT: [professional 2-3 sentence response]\n\nGenerate one unique, realistic conversation now:"

# --- Fixed values: limits of a parsed completion, both ends exclusive --------------
USER_CHARS = (10, 500)
AGENT_CHARS = (10, 800)
OPENING_CHARS = 80
ATTEMPTS_PER_EXAMPLE = 5

# --- Fixed values: forgetting severity --------------------------------------------
SEVERITY_MESSAGES = {
    "none": "No forgetting detected — model maintained or improved general knowledge.",
    "minimal": "Minimal forgetting (<5%) — acceptable for domain fine-tuning.",
    "moderate": "Moderate forgetting (5-10%) — consider adjusting training parameters.",
    "significant": "Significant forgetting (>10%) — review LoRA rank, learning rate, or epochs.",
}
MINIMAL_DROP = 0.05
MODERATE_DROP = 0.10
CHOICE_LETTERS = ["A", "B", "C", "D"]

# --- Fixed values: general-knowledge items (question, choices, answer, category) ---
KNOWLEDGE_ITEMS = [
    ("What is the capital of France?", ["Berlin", "Madrid", "Paris", "Rome"], 2, "geography"),
    ("What is the chemical symbol for water?", ["CO2", "H2O", "NaCl", "O2"], 1, "science"),
    ("Who wrote 'Romeo and Juliet'?", ["Charles Dickens", "William Shakespeare", "Jane Austen", "Mark Twain"], 1, "literature"),
    ("What is the largest planet in our solar system?", ["Mars", "Saturn", "Jupiter", "Neptune"], 2, "science"),
    ("In what year did World War II end?", ["1943", "1944", "1945", "1946"], 2, "history"),
    ("What is the square root of 144?", ["10", "11", "12", "14"], 2, "math"),
    ("Which element has the atomic number 1?", ["Helium", "Hydrogen", "Lithium", "Carbon"], 1, "science"),
    ("What is the speed of light approximately?", ["300,000 km/s", "150,000 km/s", "500,000 km/s", "100,000 km/s"], 0, "science"),
    ("Which programming language was created by Guido van Rossum?", ["Java", "C++", "Python", "Ruby"], 2, "technology"),
    ("What is the largest ocean on Earth?", ["Atlantic", "Indian", "Arctic", "Pacific"], 3, "geography"),
    ("Who developed the theory of general relativity?", ["Isaac Newton", "Albert Einstein", "Niels Bohr", "Stephen Hawking"], 1, "science"),
    ("What is the primary function of the CPU in a computer?", ["Store data", "Display graphics", "Process instructions", "Connect to internet"], 2, "technology"),
    ("How many continents are there on Earth?", ["5", "6", "7", "8"], 2, "geography"),
    ("What is photosynthesis?", ["Converting light to electricity", "Converting light energy to chemical energy in plants", "A type of chemical reaction in animals", "The process of cell division"], 1, "science"),
    ("In mathematics, what is the value of pi (π) approximately?", ["2.14", "3.14", "4.14", "1.14"], 1, "math"),
    ("Which country has the largest population in the world?", ["United States", "India", "China", "Indonesia"], 1, "geography"),
    ("What is the boiling point of water at sea level in Celsius?", ["90°C", "95°C", "100°C", "110°C"], 2, "science"),
    ("What does HTML stand for?", ["Hyper Text Markup Language", "High Tech Modern Language", "Hyper Transfer Markup Language", "Home Tool Markup Language"], 0, "technology"),
    ("Which planet is known as the Red Planet?", ["Venus", "Mars", "Jupiter", "Mercury"], 1, "science"),
    ("What is the main language spoken in Brazil?", ["Spanish", "Portuguese", "French", "English"], 1, "geography"),
]
