"""Fixed word lists of the rule tagger.

The tagger is a plain heuristic that stands in for a trained one: closed-class
words come from the lists below, everything else from the shape of the token.
A lexicon table given to ``operators.annotate`` overrules it word by word.
"""

from __future__ import annotations

# The part-of-speech tags a token may carry (Penn Treebank).
PART_OF_SPEECH_TAGS = (
    "CC CD DT EX FW IN JJ JJR JJS LS MD NN NNS NNP NNPS PDT POS PRP PRP$ RB RBR RBS "
    "RP SYM TO UH VB VBD VBG VBN VBP VBZ WDT WP WP$ WRB"
).split()
UNLISTED = "UNLISTED"

# The entity classes a token may carry.
ENTITY_CLASSES = (
    "PERSON LOCATION ORGANIZATION MISC MONEY NUMBER ORDINAL PERCENT DATE TIME "
    "DURATION SET"
).split()
NO_ENTITY = "NONE"

# Tags that make a token a noun or a verb (a number counts as a noun).
NOUN_TAGS = ("CD", "NN", "NNS", "NNP", "NNPS")
VERB_TAGS = ("VB", "VBD", "VBG", "VBN", "VBP", "VBZ")

# Closed-class words by tag, lower case.
CLOSED_CLASS = {
    "DT": "the a an this these those each every",
    "IN": "of in on at by for with from as into over under about after before "
    "because while if than through between during that",
    "TO": "to",
    "CC": "and or but nor",
    "EX": "there",
    "PRP": "i you he she it we they me him them us",
    "PRP$": "my your his her its our their",
    "MD": "can could will would shall should may might must",
    "RB": "not very also",
    "WDT": "which",
    "WP": "who what whom",
    "WP$": "whose",
    "WRB": "when where why how",
    "VB": "be",
    "VBP": "am are have do",
    "VBZ": "is has does",
    "VBD": "was were had did",
    "VBN": "been",
    "VBG": "being",
    "CD": "one two three four five six seven eight nine ten",
    "JJ": "first second third",
    "NN": "today yesterday tomorrow noon midnight",
    "NNP": "january february april june july august september october november "
    "december monday tuesday wednesday thursday friday saturday sunday",
}

# Irregular lemmas; any other closed-class word is its own lemma.
IRREGULAR_LEMMAS = {
    "be": "am is are was were been being",
    "have": "has had",
    "do": "does did",
}

# Closed-class words that name an entity.
ENTITY_WORDS = {
    "NUMBER": CLOSED_CLASS["CD"],
    "ORDINAL": CLOSED_CLASS["JJ"],
    "DATE": CLOSED_CLASS["NNP"] + " today yesterday tomorrow",
    "TIME": "noon midnight",
}

CLOSED_WORDS = [w for words in CLOSED_CLASS.values() for w in words.split()]

# Default stop words for topic extraction, lower case; contractions are single tokens.
STOP_WORDS = (
    "ain't aren't can't couldn't didn't doesn't don't hadn't hasn't haven't he'd he'll i'd "
    "i'll i'm i've isn't it'd it'll let's mightn't mustn't needn't shan't she'd she'll "
    "shouldn't they'd they'll they're they've wasn't we'd we'll we're we've weren't won't "
    "wouldn't you'd you'll you're you've "
    "a about above after again against all also am an and any are as at be because "
    "been before being below between both but by can could did do does doing down "
    "during each few for from further had has have having he her here hers herself "
    "him himself his how i if in into is it its itself just me might more most must "
    "my myself no nor not now of off on once only or other our ours ourselves out "
    "over own same shall she should so some such than that the their theirs them "
    "themselves then there these they this those through to too under until up very "
    "was we were what when where which while who whom whose why will with would you "
    "your yours yourself yourselves"
).split()
