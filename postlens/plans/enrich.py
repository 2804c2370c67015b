"""The enrichment every post goes through; the same function serves batch frames and micro-batches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import entities, sentiment, stemming, text
from postlens.functions.literals import in_set, map_value
from postlens.plans import joined
from postlens.plans.joined import DictionaryTables
from postlens.sources import dictionaries

KINDS = ("person", "company", "country", "location")


@dataclass(frozen=True)
class Dictionaries:
    """Dictionaries of checked, small size, used as plan literals."""

    positive: frozenset[str]
    negative: frozenset[str]
    slang: Mapping[str, str]
    roots: frozenset[str]
    entities: Mapping[str, tuple[Iterable[str], Iterable[str]]]
    gazetteer: Mapping[str, tuple[str, str]]
    event_stems: Sequence[str]


def literals(tables: DictionaryTables, limit: int = dictionaries.LITERAL_LIMIT) -> Dictionaries | None:
    """The tables as literals, if each has at most ``limit`` rows."""
    found = {name: dictionaries.bounded_rows(getattr(tables, name), limit) for name in DictionaryTables.__annotations__}
    if any(rows is None for rows in found.values()):
        return None
    words = {name: frozenset(r.word for r in found[name]) for name in ("positive", "negative", "roots", "event_stems")}
    return Dictionaries(
        positive=words["positive"],
        negative=words["negative"],
        slang={r.key: r.value for r in found["slang"]},
        roots=words["roots"],
        entities=dictionaries.entity_sets(found["entities"]),
        gazetteer={r.place: (r.latitude, r.longitude) for r in found["gazetteer"]},
        event_stems=tuple(sorted(words["event_stems"])),
    )


def load_dictionaries(
    spark, positive: str, negative: str, slang: str, roots: str, entity_dir: str, gazetteer: str, event_stems: str,
    limit: int = dictionaries.LITERAL_LIMIT,
) -> Dictionaries | DictionaryTables:
    """Dictionaries from files: literals if all are small, else tables. :func:`enrich` takes either."""
    words = lambda path: dictionaries.word_set(dictionaries.read_lines(spark, path))
    tables = DictionaryTables(
        positive=words(positive),
        negative=words(negative),
        slang=dictionaries.slang_table(dictionaries.read_lines(spark, slang)),
        roots=words(roots),
        entities=dictionaries.entity_dictionary(
            dictionaries.read_lines(spark, [f"{entity_dir}/b_*.txt", f"{entity_dir}/i_*.txt"])
        ),
        gazetteer=dictionaries.gazetteer(dictionaries.read_lines(spark, gazetteer)),
        event_stems=words(event_stems),
    )
    return literals(tables, limit) or tables


def slang_tokens(words: str, slang: Mapping[str, str]) -> Column:
    """Tokens with slang replaced; a token is looked up in lower case and otherwise kept as written."""
    value = map_value("lower(__w)", slang)
    return F.expr(
        f"transform({words}, __w -> CASE WHEN {in_set('lower(__w)', slang)} THEN {value} ELSE __w END)"
    )


def with_normalized(df: DataFrame, source: str, dicts: Dictionaries, out: str = "normalized") -> DataFrame:
    """Stem, replace slang, clean: in this order."""
    return (
        df.withColumn("_raw", stemming.stem_tokens_of(F.col(source)))
        .withColumn("_stems", stemming.stem_words("_raw", dicts.roots))
        .withColumn(out, text.clean_text(F.array_join(slang_tokens("_stems", dicts.slang), " ")))
        .drop("_raw", "_stems")
    )


def with_sentiment(df: DataFrame, words: str, dicts: Dictionaries) -> DataFrame:
    pos, neg = sentiment.hit_counts(words, dicts.positive, dicts.negative)
    return (
        df.withColumns({"_pos": pos, "_neg": neg})
        .withColumns(
            {
                "sentiment": sentiment.label(F.col("_pos"), F.col("_neg")),
                "total_score": sentiment.score(F.col("_pos"), F.col("_neg")),
            }
        )
        .drop("_pos", "_neg")
    )


def _with_entity_text(df: DataFrame) -> DataFrame:
    """Entity arrays as comma-separated text; the three place columns stay aligned."""
    return df.withColumns(
        {
            "person": entities.joined(F.col("_person")),
            "company": entities.joined(F.col("_company")),
            "eventNegatif": entities.joined(F.col("_event")),
            "country": entities.joined(F.col("_country")),
            "city": entities.joined(F.col("_places.place")),
            "lat_city": entities.joined(F.col("_places.lat")),
            "long_city": entities.joined(F.col("_places.long")),
        }
    ).drop("_person", "_company", "_country", "_location", "_places", "_event")


def with_entities(df: DataFrame, words: str, dicts: Dictionaries) -> DataFrame:
    """Entity columns as comma-separated text."""
    kinds = {kind: dicts.entities.get(kind, ((), ())) for kind in KINDS}
    typed = entities.with_types(df, words, kinds, "_")
    events = entities.by_stem(words, dicts.event_stems, dicts.roots)
    found = typed.withColumns({"_event": events, "_places": entities.located("_location", dicts.gazetteer)})
    return _with_entity_text(found)


def enrich(
    df: DataFrame, dicts: Dictionaries | DictionaryTables, source: str = "text", id_cols: Sequence[str] = ()
) -> DataFrame:
    """Appends the nine analysis columns.

    With literals it is row-local: no shuffle, no Python. With tables it joins, and ``id_cols`` must identify a row.
    """
    if isinstance(dicts, DictionaryTables):
        if not id_cols:
            raise ValueError("dictionaries that are tables need the columns that identify a row")
        return _enrich_joined(df, dicts, source, id_cols)
    normalized = with_normalized(df, source, dicts, "_normalized")
    scored = with_sentiment(
        normalized.withColumn("_words", text.split_cleaned(F.col("_normalized"))), "_words", dicts
    )
    tokens = text.with_word_tokens(scored, source, "_tokens")
    tagged = with_entities(tokens, "_tokens", dicts)
    return tagged.drop("_normalized", "_words", "_tokens")


def _enrich_joined(df: DataFrame, dicts: DictionaryTables, source: str, ids: Sequence[str]) -> DataFrame:
    found = joined.found_words(df.select(*ids, source), ids, source, dicts, KINDS)
    lists = [f"_{kind}" for kind in KINDS] + ["_event", "_places"]
    both = df.join(found, list(ids), "left")
    # A row without any match has no entities; one without a text has no answer.
    nothing = {c: F.when(F.col(source).isNotNull(), F.coalesce(c, F.array().cast(found.schema[c].dataType))) for c in lists}
    pos, neg = F.coalesce("_pos", F.lit(0)), F.coalesce("_neg", F.lit(0))
    scored = both.withColumns({"sentiment": sentiment.label(pos, neg), "total_score": sentiment.score(pos, neg)} | nothing)
    return _with_entity_text(scored).drop("_pos", "_neg")
