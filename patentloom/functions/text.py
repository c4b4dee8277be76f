"""Tokens, stop words, keyword strings and lemmas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark ML's default English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about against between
into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()

# Characters removed from keyword strings, repeated and outer commas.
KEYWORD_NOISE = r"""["'\[\]{}().]"""
REPEATED_COMMAS = r",,+"
OUTER_COMMAS = r"(^,|,$)"

# Words that end like a plural and are none.
NO_PLURALS = """
analysis apparatus basis bias bus canvas chassis corpus dns electronics focus gas gps genus
glass lens mathematics mechanics news optics physics process radius robotics series species
status thesis virus
""".split()

# Irregular plurals common in technical prose.
IRREGULAR_LEMMAS = {
    "analyses": "analysis",
    "axes": "axis",
    "bases": "basis",
    "children": "child",
    "criteria": "criterion",
    "feet": "foot",
    "indices": "index",
    "matrices": "matrix",
    "men": "man",
    "mice": "mouse",
    "phenomena": "phenomenon",
    "teeth": "tooth",
    "vertices": "vertex",
    "women": "woman",
}


def tokens(text: Column) -> Column:
    """Lower-cased words between white space, without empty ones."""
    return F.filter(F.split(F.lower(text), r"\s"), lambda word: word != "")


def without_stop_words(words: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda word: ~word.isin(stop_words))


def stripped(text: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def keyword_string(words: Column) -> Column:
    return F.concat_ws(", ", words)


def cleaned_keyword_string(raw: Column) -> Column:
    """Drop quotes, brackets and dots, then tidy the commas left behind."""
    bare = F.regexp_replace(raw, KEYWORD_NOISE, "")
    single = F.regexp_replace(bare, REPEATED_COMMAS, ",")
    return F.trim(F.regexp_replace(single, OUTER_COMMAS, ""))


def singular_forms(word: Column) -> Column:
    """What a word may be the plural of, likeliest first; empty for most words."""
    long = F.length(word) > 3
    return F.array_compact(
        F.array(
            F.when(long & word.rlike("[^aeiou]ies$"), F.regexp_replace(word, "ies$", "y")),
            F.when(long & word.rlike("[^s]s$"), F.regexp_replace(word, "s$", "")),
            F.when(long & word.rlike("(s|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", "")),
        )
    )
