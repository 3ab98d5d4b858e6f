"""Fixed values of the article-scoring contract."""

# Request limits in characters and the shortest scorable text in words.
MAX_HEADLINE_CHARS = 1000
MAX_ARTICLE_CHARS = 100000
MIN_WORDS = 20

# Class ids and their names.
FAKE, REAL = 0, 1
FAKE_NAME, REAL_NAME = "Fake", "Real"

# Model names, decision methods and the joiner of an agreed verdict.
FOREST_NAME = "Random Forest"
SEQUENCE_NAME = "BERT"
LINEAR_NAME = "Logistic Regression"
NAME_JOINER = " + "
METHOD_AGREE = "Both models agree"
METHOD_DISAGREE = "Models disagree - higher-confidence prediction selected"

# Rejection messages.
EMPTY_TEXT = "News text cannot be empty."
SHORT_TEXT = (
    "News contains only %d words. Please enter at least %d words. "
    "A complete article is recommended."
)
TOO_LONG = "String should have at most %d characters"
PAGE_EMPTY = "Please enter a news article."
PAGE_SHORT = "Please enter at least %d words. Current input contains %d words."
INVALID_REQUEST = "Invalid request"
SCORER_FAILED = "Scorer returned an invalid result."

# Status codes of rejected articles.
CODE_SCHEMA = 422
CODE_TEXT = 400
CODE_SCORER = 500
CODE_UNAVAILABLE = 503

# The sequence scorer reads this many tokens and answers this
# probability when it cannot score.
MAX_TOKENS = 256
FALLBACK_PROBABILITY = 0.5
