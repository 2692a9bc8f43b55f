"""Word lists for the test corpus, whose invented prose hardly holds an English opinion word.

They stand where an application would pass its own keywords and lexicon.
"""

from plaudit.functions.sentiment import Lexicon

KEYWORDS = ("great", "sch", "mente", "inoran", "hehely")
WHOLE_WORDS = ("the", "und", "que")
PLACEHOLDERS = ("that it.", "die tz.")

LEXICON = Lexicon(
    polarity={
        "and": 0.2, "das": 0.7, "der": 0.25, "des": 0.4, "die": -0.2, "du": -0.7, "et": -0.1,
        "for": 0.05, "great": 0.8, "hehely": 1.0, "la": 0.15, "le": 0.2, "les": -0.5, "los": 0.5,
        "ononst": -1.0, "que": -0.35, "that": -0.3, "the": 0.1, "this": 0.6, "und": 0.3,
        "une": 0.8, "von": -0.6, "was": -0.4, "with": 0.3,
    },
    intensity={"en": 0.5, "in": 1.3, "is": 1.2, "zu": 1.5},
    negations=("as", "el", "no", "of"),
)

TOP_LIMITED_ROWS = 500
# Labels and the first documents by id that they stand for.
ROW_LIMITS = {20: 100, 40: 300, 60: 500, 80: 700, 100: 1_000_000_000}
REPLAY_DELAY_SECONDS = 600
LATE_DELAY_SECONDS = 10 * 86_400
WHOLE_FEED_SECONDS = 400 * 86_400
COMPARED_MODES = ("view", "click")
