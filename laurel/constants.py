"""Default vocabularies.

Fixed values: the results of the default jobs depend on exactly these words,
names and patterns.  Every operator takes them as parameters, so that another
event or language only needs other lists.
"""

# --- fixed values: cleaning patterns -------------------------------------
FOREIGN_CHARACTER = r"[^\x00-\x7F\x{263A}-\x{1F645}]"
NON_ASCII_CHARACTER = r"[^\x00-\x7F]"
URL = r"http\S+|www\S+|pic.twitter\S+"
EMOJI_BLOCKS = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}]"
)
RETWEET_POST = r"(?i)^rt @\w+"
HASHTAG = r"#\S+"
NOT_ALNUM_AT_BLANK = r"[^A-Za-z0-9@ ]+"
RETWEETED_ACCOUNT = r"^RT @(\w+):"

# --- fixed values: trigger words -----------------------------------------
WINNER_WORDS = ["wins"]
WINNER_WORDS_WIDE = ["wins", "won", "receives"]
WINNER_WORDS_CAPTURE = ["win", "wins", "won", "awarded"]
WINNER_WORDS_LOOSE = ["win", "wins", "won", "winner", "awarded", "receive", "received", "gets"]
NOMINEE_WORDS = ["nominee", "nominate", "nominated"]
NOMINEE_WORDS_NOUN = ["nominated", "nominee", "nomination"]
NOMINEE_WORDS_HOPE = [
    "nominated", "nominee", "nomination", "hope", "wish", "think", "believe", "should",
]
HOPE_WORDS = ["hope", "wish", "think", "believe", "should"]
PRESENTER_WORDS = ["presenter", "presenting", "presented", "presents", "present"]
PRESENTER_WORDS_NEAR = ["presenting", "presented", "presents", "present"]
HOST_WORDS = ["host", "hosts", "hosting"]
AWARD_WORDS = [
    "best", "award", "outstanding", "favorite", "favourite", "top", "honor", "prize", "choice",
]
JOKE_PHRASES = ["best joke", "funniest joke", "best comedian", "funniest moment"]
DRESS_PHRASES = ["best dressed"]

# --- fixed values: span rules --------------------------------------------
SUBJECT_VERBS = ["wins", "won", "receives"]
AFTER_STOP_TOKENS = [".", ",", ":", ";", "!", "?", "RT", "@", "#"]
AFTER_STOP_TOKENS_HYPHEN = [".", ",", ":", ";", "!", "?", "-", "RT", "@", "#"]
AFTER_STOP_WORDS = ["for", "win", "won", "by", "goes"]
CLAUSE_VERBS = [
    "is", "are", "was", "were", "be", "been", "has", "had", "have", "does", "did", "will",
    "would", "can", "could", "wins", "winning", "receives", "presents", "presented",
]
AWARD_ENDINGS = ["award", "honor", "prize", "trophy"]
FALLBACK_AWARD_WORDS = ["award", "prize", "honor", "medal", "trophy"]
ARTEFACT = r"(?i)(win|#|@)"
NOT_A_PERSON = ["goldenglobes", "rt", "tv", "movie", "film"]
AWARD_DESCRIPTORS = ["Best", "Outstanding", "Top", "Achievement in", "Excellence in"]
AWARD_CATEGORIES = [
    "Actor", "Actress", "Director", "Picture", "Screenplay", "Soundtrack", "Album", "Song",
    "Artist", "Performance", "Music Video", "Television Series", "Drama", "Comedy", "Animated",
    "Documentary", "Feature Film", "Reality Show", "Supporting Actor", "Supporting Actress",
]
PATTERN_STOP_WORDS = ["in", "a", "the", "of", "–", "-", "or"]
MERGE_GUARD_WORDS = ["Actor", "Actress", "Director", "Screenplay"]
LOOKUP_ROLES = ["actor", "actress", "director"]

# --- fixed values: names of award shows, never an award or a person ------
SHOW_NAMES = [
    "GoldenGlobes", "Golden Globes", "Oscars", "Academy Awards", "Emmys", "Grammy Awards",
    "BAFTA", "SAG Awards", "Tony Awards", "Cannes Film Festival", "MTV Video Music Awards",
    "American Music Awards", "Critics Choice Awards", "People's Choice Awards",
    "Billboard Music Awards", "BET Awards", "Teen Choice Awards",
    "Country Music Association Awards", "Academy of Country Music Awards",
    "Golden Globe Awards", "Emmy Awards", "Grammy", "Cannes", "MTV Awards",
]

# --- fixed values: canonical awards of the 2013 event --------------------
CANONICAL_AWARDS = [
    "best screenplay - motion picture",
    "best director - motion picture",
    "best performance by an actress in a television series - comedy or musical",
    "best foreign language film",
    "best performance by an actor in a supporting role in a motion picture",
    "best performance by an actress in a supporting role in a series, mini-series or motion picture made for television",
    "best motion picture - comedy or musical",
    "best performance by an actress in a motion picture - comedy or musical",
    "best mini-series or motion picture made for television",
    "best original score - motion picture",
    "best performance by an actress in a television series - drama",
    "best performance by an actress in a motion picture - drama",
    "cecil b. demille award",
    "best performance by an actor in a motion picture - comedy or musical",
    "best motion picture - drama",
    "best performance by an actor in a supporting role in a series, mini-series or motion picture made for television",
    "best performance by an actress in a supporting role in a motion picture",
    "best television series - drama",
    "best performance by an actor in a mini-series or motion picture made for television",
    "best performance by an actress in a mini-series or motion picture made for television",
    "best animated feature film",
    "best original song - motion picture",
    "best performance by an actor in a motion picture - drama",
    "best television series - comedy or musical",
    "best performance by an actor in a television series - drama",
    "best performance by an actor in a television series - comedy or musical",
]

# --- fixed values: answers that stand for a work (alias, target) ---------
WORK_ALIASES = {
    "johann johannsson": "the theory of everything",
    "alexandre desplat": "the imitation game",
    "trent reznor and atticus ross": "gone girl",
    "antonio sanchez": "birdman",
    "hans zimmer": "interstellar",
    "glory": "selma",
    "big eyes": "big eyes",
    "mercy is": "noah",
    "opportunity": "annie",
    "yellow flicker beat": "the hunger games mockingjay part 1",
    "alejandro gonzalez inarritu": "birdman",
    "wes anderson": "the grand budapest hotel",
    "gillian flynn": "gone girl",
    "richard linklater": "boyhood",
    "graham moore": "the imitation game",
}
# the award that has no nominees and is left out of the nominee score
NO_NOMINEES_AWARD = "cecil b. demille award"
