"""Fixed values. They decide the results, so they stand here as plain text."""

# The keywords a streamed review must contain one of.
STREAM_KEYWORDS = ("great", "poor", "excellent", "bad", "quality", "awesome", "terrible")

# The short stop-word list of the stream (empty tokens go as well).
STREAM_STOP_WORDS = ("a", "the", "and", "is")

# Spark ML's default English stop words, 181 of them.
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# A polarity strictly beyond these bounds is positive or negative.
POSITIVE_ABOVE = 0.05
NEGATIVE_BELOW = -0.05
CATEGORIES = ("positive", "negative", "neutral")

# Sample percentages, and the row limits that stand for them.
FRACTIONS = (20, 40, 60, 80, 100)
ROW_LIMITS = {20: 20_000, 40: 40_000, 60: 60_000, 80: 80_000, 100: 100_000}

# Report sizes, the sliding window in seconds, key range.
TOP_WORDS = 10
WINDOW_TOP_WORDS = 5
WINDOW_SECONDS = 300
SLIDE_SECONDS = 60
PARTITION_KEYS = 1001

# Scoring rule: a negated word counts by this factor; scores are summed in millionths.
NEGATION_FACTOR = -0.5
SCORE_UNIT = 1_000_000

# A short list of our own for English reviews, set by hand in quarters; taken from no published
# lexicon and no match for one. Load a full one with ``Lexicon.from_table``.
STARTER_POLARITY = {
    "amazing": 0.75, "awesome": 1.0, "awful": -1.0, "bad": -0.75, "beautiful": 0.75,
    "best": 1.0, "better": 0.5, "boring": -0.5, "broken": -0.75, "cheap": -0.25,
    "comfortable": 0.5, "defective": -0.75, "disappointed": -0.75, "disappointing": -0.75,
    "easy": 0.5, "excellent": 1.0, "expensive": -0.25, "fast": 0.25, "faulty": -0.75,
    "fine": 0.25, "flimsy": -0.5, "good": 0.75, "great": 0.75, "happy": 0.75,
    "horrible": -1.0, "impressive": 0.75, "love": 0.75, "nice": 0.5, "perfect": 1.0,
    "pleased": 0.5, "poor": -0.5, "poorly": -0.5, "reliable": 0.5, "slow": -0.25,
    "solid": 0.5, "terrible": -1.0, "ugly": -0.5, "useful": 0.5, "useless": -0.75,
    "waste": -0.75, "wonderful": 1.0, "worst": -1.0, "worthless": -1.0, "wrong": -0.5,
}
STARTER_INTENSITY = {
    "absolutely": 1.5, "barely": 0.5, "extremely": 1.5, "quite": 1.25, "really": 1.25,
    "slightly": 0.5, "so": 1.25, "somewhat": 0.75, "too": 1.25, "totally": 1.5, "very": 1.25,
}
STARTER_NEGATIONS = (
    "no", "not", "never", "ain't", "aren't", "can't", "cannot", "couldn't", "didn't",
    "doesn't", "don't", "hadn't", "hasn't", "haven't", "isn't", "shouldn't", "wasn't",
    "weren't", "won't", "wouldn't",
)
