"""Results depend on these exact words, patterns and numbers."""

# Stop words (English list, in its natural order); single letters a-z are added by rule.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now"
).split()

# A token is punctuation when it is a substring of this string.
PUNCTUATION = '.,?![]:;\\/\\()"{}-$%^&*'

# Text substitutions: placeholders.
URL_MARK = "URLsub"
SHORT_URL_MARK = "shortURLsub"
NUMBER_MARK = "NUMBERsub"
IMAGE_MARK = "IMGsub"
HTML_MARK = "HTMLTags"

# Pruning of n-gram counts: keep cnt > max(floor, int(share * total)).
UNIGRAM_FLOOR = 20
PHRASE_FLOOR = 3
UNIGRAM_SHARE = 1e-7
PHRASE_SHARE = 5e-8

# Community label of corpus-wide series.
ALL_COMMUNITIES = "allsubreddit"

# Accounts and communities left out of the author graph.
SYSTEM_AUTHORS = ("[deleted]", "AutoModerator")
GRAPH_SKIPPED_COMMUNITIES = ("AskReddit", "reddit.com")
GRAPH_SKIPPED_NODE = "reddit.com"

# Author graph: comments that make a member, common authors that make an edge.
ACTIVE_COMMENTS = 50
EDGE_AUTHORS = 5
RELATIVE_WEIGHT = 0.2
HUB_DEGREE = 100

# Month spine of the trend charts (end exclusive) and sizes of reports.
FIRST_MONTH = "2007-10-01"
END_MONTH = "2016-01-01"
TOP_COMMUNITIES = 5
SEARCH_HITS = 80

# Page titles and link targets with these name spaces are left out.
PAGE_NAMESPACES = ("template:", "file:")

# Follower counts that make an account influential: at the seed, and deeper.
INFLUENCE_FIRST = 200
INFLUENCE_DEEPER = 100
