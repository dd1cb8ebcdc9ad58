"""Fixed values that results depend on.

Everything here is a constant that must keep its exact value for results to
match: character classes, patterns, keep-sets, word lists, score maps. They
are written out plainly, in natural order. Patterns are written so the same
text works in Java regex (Spark) and, where noted, in RE2 (the SQL oracle).
"""
from __future__ import annotations

# --- FIXED VALUES: character classes (Python's Unicode \w, \s, \d) ---------
WORD = r"\p{L}\p{N}_"
SPACE = (r"\t\n\x{0B}\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
DIGIT = r"\p{Nd}"

# --- FIXED VALUES: masking patterns and placeholders ------------------------
URL_RE = r"(?i)(?:https?://|www\.)[^" + SPACE + r"]+"
EMAIL_BODY = r"[" + WORD + r".+-]+@[" + WORD + r"-]+\.[" + WORD + r".-]+"
PHONE_RE = r"\+?" + DIGIT + r"[" + DIGIT + r"\-" + SPACE + r"().]{6,}" + DIGIT
MENTION_RE = r"@[" + WORD + r"]+"
HASHTAG_RE = r"#([" + WORD + r"]+)"
URL_TOKEN = " <URL> "
EMAIL_TOKEN = " <EMAIL> "
PHONE_TOKEN = " <PHONE> "
USER_TOKEN = " <USER> "
NUM_TOKEN = " <NUM> "

# Non-printable characters (defined by the source, never called there).
NON_PRINTABLE_RE = r"[^\x{09}\x{0A}\x{0D}\x{20}-\x{7E}\x{A0}-\x{FFFF}]"

# --- FIXED VALUES: ASCII punctuation and the three keep-sets ---------------
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KEEP_EMBEDDINGS = "<>:_-"
KEEP_CLASSIFICATION = "<>:_!?"
KEEP_SENTIMENT = "<>:_!?'-"

# --- FIXED VALUES: scam feature patterns ------------------------------------
HAS_URL_RE = r"(?i)http|www\."
HAS_PHONE_RE = r"\+?" + DIGIT + r"[" + DIGIT + r"\-" + SPACE + r"]{6,}"
HAS_MONEY_RE = r"(?i)\$|usd|btc|eur|crypto|inheritance"

# --- FIXED VALUES: English stop words, minus the kept negations/intensifiers
STOPWORDS_BASE = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself "
    "it it's its itself they them their theirs themselves what which who whom "
    "this that that'll these those am is are was were be been being have has "
    "had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will "
    "just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan "
    "shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()
STOPWORDS_KEEP = ("no", "not", "nor", "never", "very", "too", "more", "most",
                  "but", "however")
STOPWORDS = tuple(w for w in STOPWORDS_BASE if w not in STOPWORDS_KEEP)

# --- FIXED VALUES: contraction rules (pattern, replacement), in order ------
# Stems keep their case through the capture group.
_APOS = "['’]"
CONTRACTIONS = (
    (r"(?i)(?<![" + WORD + r"])(ca)n" + _APOS + r"t(?![" + WORD + r"])", "$1nnot"),
    (r"(?i)(?<![" + WORD + r"])(w)on" + _APOS + r"t(?![" + WORD + r"])", "$1ill not"),
    (r"(?i)(?<![" + WORD + r"])(sha)n" + _APOS + r"t(?![" + WORD + r"])", "$1ll not"),
    (r"(?i)(?<![" + WORD + r"])(a)in" + _APOS + r"t(?![" + WORD + r"])", "$1re not"),
    (r"(?i)(?<![" + WORD + r"])([" + WORD + r"]+)n" + _APOS + r"t(?![" + WORD + r"])", "$1 not"),
    (r"(?i)(?<![" + WORD + r"])(you|we|they|who|what)" + _APOS + r"re(?![" + WORD + r"])", "$1 are"),
    (r"(?i)(?<![" + WORD + r"])(i|you|we|they|who|would|should|could|might|must)"
     + _APOS + r"ve(?![" + WORD + r"])", "$1 have"),
    (r"(?i)(?<![" + WORD + r"])(i|you|he|she|it|we|they|that|there|who|what)"
     + _APOS + r"ll(?![" + WORD + r"])", "$1 will"),
    (r"(?i)(?<![" + WORD + r"])(i)" + _APOS + r"m(?![" + WORD + r"])", "$1 am"),
    (r"(?i)(?<![" + WORD + r"])(i|you|he|she|it|we|they|that|there|who|what)"
     + _APOS + r"d(?![" + WORD + r"])", "$1 would"),
    (r"(?i)(?<![" + WORD + r"])(it|that|what|where|there|here|who|how|he|she)"
     + _APOS + r"s(?![" + WORD + r"])", "$1 is"),
    (r"(?i)(?<![" + WORD + r"])(let)" + _APOS + r"s(?![" + WORD + r"])", "$1 us"),
    (r"(?i)(?<![" + WORD + r"])(y)" + _APOS + r"all(?![" + WORD + r"])", "$1ou all"),
)

# --- FIXED VALUES: noun lemmas (irregular forms), then suffix rules --------
IRREGULAR_NOUNS = {
    "men": "man", "women": "woman", "children": "child", "feet": "foot",
    "teeth": "tooth", "mice": "mouse", "geese": "goose", "wives": "wife",
    "knives": "knife", "lives": "life", "leaves": "leaf", "wolves": "wolf",
}

# --- FIXED VALUES: tokenizer pattern ----------------------------------------
# words (inner hyphens kept), apostrophe clitics, any other single symbol
TOKEN_RE = (r"[" + WORD + r"]+(?:-[" + WORD + r"]+)*|['\x{2019}][" + WORD + r"]+|[^"
            + SPACE + WORD + r"]")
# scikit-learn's default analyzer: runs of two or more word characters
TERM_RE = r"[" + WORD + r"]{2,}"

# --- FIXED VALUES: emotion scores (module map and notebook map) ------------
EMOTION_SCORE = {
    "angry": -3.0, "frustrated": -2.5, "annoyed": -2.0, "bored": -1.5,
    "disengaged": -1.0, "sarcastic": -0.5, "neutral": 0.0, "polite": 0.5,
    "interested": 1.0, "playful": 1.5, "happy": 2.0, "excited": 2.5,
}
EMOTION_SCORE_NOTEBOOK = {
    "angry": -3.0, "frustrated": -2.5, "annoyed": -2.0, "disengaged": -1.5,
    "bored": -1.0, "sarcastic": -0.5, "neutral": 0.0, "polite": 0.5,
    "playful": 1.0, "interested": 1.5, "happy": 2.0, "excited": 2.5,
}
SENTIMENT_LABELS = ("negative", "neutral", "positive")

# --- FIXED VALUES: confidence bands around a threshold ---------------------
BAND_BORDERLINE = 0.08
BAND_MODERATE = 0.20
BAND_LABELS = ("borderline", "moderate", "high")

# --- FIXED VALUES: prompt template for persona facts -----------------------
PROMPT_TEMPLATE = (
    "Persona facts:\n%s\n\n"
    "Rewrite as a short, natural first-person dating bio (max 2 sentences), "
    "grounded ONLY in the facts above (do not invent new facts).\n"
    "Then write ONE playful, specific icebreaker someone could send after matching.\n"
    'Return JSON only, no prose: {"bio": "...", "icebreaker": "..."}'
)
CHAT_USER_TEMPLATE = "Bio: %s\nWrite an icebreaker."

# --- FIXED VALUES: defaults of the evaluation steps ------------------------
SEED = 42
RELEVANCE_THRESHOLD = 0.35
K_VALUES = (1, 3, 5)
TEMPERATURES = (0.5, 0.8, 1.0)
EVAL_HOLDOUT = 75

# Persona lines: ``N your persona: fact``; number 1 opens a block. Fixed values.
PERSONA_FIELDS = ("persona_b", "persona", "personality", "personas", "your_persona")
PERSONA_START_RE = "(?i)^1[" + SPACE + "]+your persona:"
PERSONA_FACT_RE = "(?i)^" + DIGIT + "+[" + SPACE + "]+your persona:[" + SPACE + r"]+([^\n]+)"

# Latin letters without a canonical decomposition and their ASCII forms (fixed values).
LATIN_LETTERS = (
    ("Æ", "AE"), ("Ð", "D"), ("Ø", "O"), ("Þ", "Th"), ("ß", "ss"), ("æ", "ae"), ("ð", "d"), ("ø", "o"), ("þ", "th"),
    ("Đ", "D"), ("đ", "d"), ("Ħ", "H"), ("ħ", "h"), ("ı", "i"), ("ĸ", "k"), ("Ł", "L"), ("ł", "l"), ("Ŋ", "NG"),
    ("ŋ", "ng"), ("Œ", "OE"), ("œ", "oe"), ("Ŧ", "T"), ("ŧ", "t"),
)
