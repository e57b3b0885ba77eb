"""Enrichment responses: nested JSON bindings to one row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse import rules

# Response variables and the columns they fill.
_VARIABLES = {
    "movementLabel": "movement",
    "educationLabel": "education",
    "influencedByLabel": "influenced_by",
    "birthPlaceLabel": "birth_place",
    "birthCountryLabel": "birth_place_country",
    "deathPlaceLabel": "death_place",
    "bioDescription": "bio_text",
}
_LISTS = {"movement": "movements", "education": "education", "influenced_by": "influenced_by"}
_SCALARS = ("birth_place", "birth_place_country", "death_place", "bio_text")
DETAIL_COLUMNS = (*_LISTS.values(), *_SCALARS)

# JSON texts that hold nothing: a response of that kind counts as none.
_NOTHING = r'^\s*(\{\s*\}|\[\s*\]|null|false|0|"")\s*$'


def answer(payload: Column) -> Column:
    """The response as a variant, parsed once; NULL if it holds nothing or is no whole JSON text: error pages, half of a text.

    The parser stops at the end of a value and leaves what follows; inside brackets it has to read on.
    """
    inside = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    alone = F.try_variant_get(inside, "$[1]", "variant").isNull()
    return F.when(~F.rlike(payload, F.lit(_NOTHING)) & alone, F.try_variant_get(inside, "$[0]", "variant"))


def is_answer(payload: Column) -> Column:
    """Whether a response is whole JSON that holds something; error pages and truncated texts are not."""
    return answer(payload).isNotNull()


def bindings_of(parsed: Column) -> Column:
    """The bindings of a parsed response, in order: the address of the item and the label values."""
    def value(binding: Column, variable: str) -> Column:
        return F.try_variant_get(binding, f"$.{variable}.value", "string")

    return F.transform(
        F.try_variant_get(parsed, "$.results.bindings", "array<variant>"),
        lambda b: F.struct(value(b, "item").alias("address"), *[value(b, variable).alias(name) for variable, name in _VARIABLES.items()]),
    )


def _entity(address: Column) -> Column:
    return F.substring_index(address, "/", -1)


def binding_rows(responses: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """One row per binding: response key, ``qid``, ``pos`` in the response, and the label values.

    The entity id is the last part of the item's address; bindings without an item are skipped.
    """
    parsed = responses.select(key, F.posexplode(bindings_of(answer(F.col(payload)))).alias("pos", "b"))
    return parsed.where(F.col("b.address").isNotNull()).select(key, _entity(F.col("b.address")).alias("qid"), "pos", *[f"b.{x}" for x in _VARIABLES.values()])


def response_details(responses: DataFrame, key: str, payload: str = "payload", qid: str | None = None) -> DataFrame:
    """``response, qid`` and what that response says of the entity: distinct labels in order, first scalars.

    Bindings are grouped where they stand, in the array of their response. Without ``qid``, they name their entity; with
    it, all bindings of a response are of the entity in that column.
    """
    parsed = responses.select(
        F.col(key).alias("response"), *([] if qid is None else [F.col(qid).alias("qid")]), bindings_of(answer(F.col(payload))).alias("b"))
    if qid is None:
        ids = F.array_distinct(F.transform(F.filter("b", lambda x: x["address"].isNotNull()), lambda x: _entity(x["address"])))
        parsed = parsed.select("response", "b", F.explode(ids).alias("qid")).withColumn(
            "b", F.filter("b", lambda x: F.coalesce(_entity(x["address"]) == F.col("qid"), F.lit(False))))
    else:
        parsed = parsed.where(F.size("b") > 0)

    def labels(name: str) -> Column:
        return F.filter(F.transform("b", lambda x: x[name]), lambda x: x != "")

    return parsed.select(
        "response", "qid", *[F.array_distinct(labels(name)).alias(name) for name in _LISTS],
        *[F.get(labels(name), F.lit(0)).alias(name) for name in _SCALARS])


def merged_details(details: DataFrame) -> DataFrame:
    """One row per ``qid``: distinct labels in the order of responses and of positions in them, and first scalars.

    One shuffle by entity: an entity with very many bindings arrives as a row of distinct labels per response.
    """
    names = [*_LISTS, *_SCALARS]
    rows = details.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("response", *names))).alias("r"))

    def listed(name: str) -> Column:
        found = F.array_distinct(F.flatten(F.transform("r", lambda x: x[name])))
        return F.when(F.size(found) > 0, found)

    def first(name: str) -> Column:
        return F.get(F.filter(F.transform("r", lambda x: x[name]), lambda x: x.isNotNull()), F.lit(0))

    return rows.select(
        "qid", listed("movement").alias("movements"), F.array_join(listed("education"), ", ").alias("education"),
        listed("influenced_by").alias("influenced_by"),
        *[first(name).alias(name) for name in _SCALARS])


def only_requested(bindings: DataFrame, requests: DataFrame) -> DataFrame:
    """Drop bindings of entities that no request asked for.

    Which request brought them does not matter: batch numbers shift when the artists do.
    """
    return bindings.join(requests.select("qid"), "qid", "left_semi")


def unrequested_bindings(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Gate: bindings of entities that no request asked for, as answers to an older export have them."""
    asked = requests.select(F.col("wikidata_id").alias("qid"))
    foreign = binding_rows(responses, "batch_no").join(asked, "qid", "left_anti")
    return foreign.agg(F.count("*").alias("failures")).select(F.lit("bindings nobody asked for").alias("check"), "failures")


def fetch_status(responded: Column) -> Column:
    """Failed without a response; success needs a movement, biography, birth place, education or influence."""
    telling = F.coalesce(
        F.col("movements").isNotNull(), F.lit(False)
    ) | F.col("bio_text").isNotNull() | F.col("birth_place").isNotNull() | F.col("education").isNotNull() | F.col(
        "influenced_by"
    ).isNotNull()
    return F.when(~responded, "failed").when(telling, "success").otherwise("no_data")


def enrich_artists(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Enrichment table from batched requests and their landed responses.

    ``requests``: artist_name, wikidata_id (unique), batch_no.  ``responses``: batch_no, payload
    (JSON text, NULL when the request failed).  The texts stay in a table of their own, one row per
    batch, see :func:`raw_responses`; an artist has the number of its batch.
    """
    asked = requests.select("artist_name", F.col("wikidata_id").alias("qid"), "batch_no")
    found = merged_details(only_requested(response_details(responses, "batch_no"), asked)).withColumn("_bound", F.lit(True))
    answered = responses.where(is_answer(F.col("payload"))).select("batch_no", F.lit(True).alias("_answered")).distinct()
    responded = F.col("_bound").isNotNull() | F.col("_answered").isNotNull()
    return (
        asked.join(found, "qid", "left")
        .join(answered, "batch_no", "left")
        .select(
            "artist_name", F.col("qid").alias("wikidata_id"), *DETAIL_COLUMNS, "batch_no",
            F.current_timestamp().alias("fetched_at"), fetch_status(responded).alias("fetch_status"),
        )
    )


def raw_responses(responses: DataFrame) -> DataFrame:
    """The landed text of every answered batch, once: of several answers to one batch, the first in the order of their texts."""
    answers = responses.where(is_answer(F.col("payload")))
    return answers.groupBy("batch_no").agg(F.min("payload").alias("api_response_json"))


def enrich_artists_singly(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Variant with one response per entity: any binding at all counts as success.

    ``responses``: qid, payload. Of several answers of one entity the first in the order of their texts counts.
    """
    asked = requests.select("artist_name", F.col("wikidata_id").alias("qid"))
    answered = responses.where(is_answer(F.col("payload"))).groupBy("qid").agg(F.min("payload").alias("payload"))
    details = merged_details(response_details(answered, "qid", qid="qid")).withColumn("_bound", F.lit(True))
    bound = F.col("_bound").isNotNull()
    return (
        asked.join(details, "qid", "left")
        .join(answered, "qid", "left")
        .select(
            "artist_name", F.col("qid").alias("wikidata_id"), *DETAIL_COLUMNS,
            F.when(bound, F.col("payload")).alias("api_response_json"),
            F.current_timestamp().alias("fetched_at"),
            F.when(F.col("payload").isNull(), "failed").when(bound, "success").otherwise("no_data").alias("fetch_status"),
        )
    )


def artists_with_external_id(artists: DataFrame) -> DataFrame:
    qid = F.col("wiki_qid")
    return artists.where(qid.isNotNull() & ~qid.isin(*rules.MISSING_IDS)).select(
        "display_name", "wiki_qid", "nationality", "begin_date", "end_date"
    )
