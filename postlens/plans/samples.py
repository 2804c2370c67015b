"""Small sample dictionaries for the registered queries, made of tokens frequent in the given tables.

A deployment brings its own dictionary files (``postlens.plans.enrich.load_dictionaries``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.plans.enrich import Dictionaries
from postlens.plans.joined import DictionaryTables

POSITIVE = ("the", "der", "que", "with", "est", "ist", "para", "for", "les", "attion", "orantion")
NEGATIVE = ("of", "die", "was", "no", "not", "nicht", "the", "des", "thatin", "on", "por")

# Lines as in a slang file: the last line of a repeated key wins.
SLANG_LINES = (
    "the itu lama",
    "und dan juga",
    "de dari",
    "with dengan",
    "la sang",
    "que apa que",
    "is adalah",
    "the that one",
    "ist adalah",
    "hehely ha ha",
)
SLANG = {line.split()[0]: " ".join(line.split()[1:]) for line in SLANG_LINES}

ROOTS = (
    "th", "er", "on", "est", "eau", "it", "en", "ch", "ein", "keit", "ver", "lich", "sten", "ung", "nt",
    "ntan", "te", "tier", "inor", "re", "as", "ci", "mi", "nc", "the", "ar",
)
EVENT_STEMS = ("th", "est", "eau", "keit", "inor", "tier", "sten")

ENTITIES = {
    "person": (("the", "la", "der", "el", "rewh"), ("the", "of", "and", "ci", "que", "attion")),
    "company": (("of", "de", "thatin"), ("the", "la", ",", ".", "thatin")),
    "country": (("and", "und", "le"), ("of", "the", "de", "&")),
    "location": (("in", "en", "to", "von", "a"), ("the", "la", "der")),
    "event": (("is", "ist", "est"), ("the", ".", "a")),
    "job_title": (("for", "pour"), ("of", "la", "the")),
    "organization": (("on", "auf"), ("the", "of", "der")),
    "product": (("with", "mit"), ("the", "der", "a")),
    "city": (("at", "im"), ("the", "von")),
}
GAZETTEER = {
    "in the": ("0609'S", "10649'E"),
    "to the": ("0715'S", "11245'E"),
    "en": ("0059'N", "11920'E"),
    "en la": ("0810'S", "11520'E"),
    "von": ("0255'S", "10445'E"),
    "a the": ("0335'N", "09840'E"),
    "der": ("0548'S", "10200'E"),
    "on": ("0133'S", "12400'E"),
}
VOCABULARY = {
    word: number
    for number, word in enumerate(
        ("the", "of", "de", "and", "to", "in", "a", "la", "der", "is", "that", "en", "for", "it", "on",
         "was", "die", "with", "que", "be", "le", "as", "und", "des", "by"),
        start=1,
    )
}

DICTIONARIES = Dictionaries(
    positive=frozenset(POSITIVE),
    negative=frozenset(NEGATIVE),
    slang=SLANG,
    roots=frozenset(ROOTS),
    entities=ENTITIES,
    gazetteer=GAZETTEER,
    event_stems=EVENT_STEMS,
)


def large_tables(more: DataFrame) -> DictionaryTables:
    """The same dictionaries as tables, each with the further entries ``more(word)``."""
    spark = more.sparkSession

    def words(listed) -> DataFrame:
        return spark.createDataFrame([(w,) for w in listed], "word STRING").unionByName(more)

    slang = spark.createDataFrame(list(SLANG.items()), "key STRING, value STRING")
    entities = [(kind, role, t) for kind, sides in ENTITIES.items() for role, side in zip("BI", sides, strict=True) for t in side]
    places = spark.createDataFrame([(p, *at) for p, at in GAZETTEER.items()], "place STRING, latitude STRING, longitude STRING")
    return DictionaryTables(
        positive=words(POSITIVE),
        negative=words(NEGATIVE),
        slang=slang.unionByName(more.select(F.col("word").alias("key"), F.lit("?").alias("value"))),
        roots=words(ROOTS),
        entities=spark.createDataFrame(entities, "entity_type STRING, role STRING, token STRING").unionByName(
            more.select(F.lit("person").alias("entity_type"), F.lit("B").alias("role"), F.col("word").alias("token"))
        ),
        gazetteer=places.unionByName(
            more.select(F.col("word").alias("place"), F.lit("0").alias("latitude"), F.lit("0").alias("longitude"))
        ),
        event_stems=words(EVENT_STEMS),
    )
