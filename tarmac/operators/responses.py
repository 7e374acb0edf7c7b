"""Requests to and responses from the address and flood services, as tables.

The transport itself is not here: jobs read and write logs of requests,
attempts and response bodies. ``enrich_partitions`` calls a function that the
user brings.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.geometry import DEFAULT_BUFFER_METRES, checked_buffer, point_text
from tarmac.operators.latest import keep_earliest
from tarmac.operators.ranking import number_rows
from tarmac.schemas import (
    FLOOD_SCORE_NAMES,
    GEOCODE_COLUMNS,
    GEOCODE_RESPONSE,
    flood_depth_paths,
    flood_depth_schema,
    flood_score_schema,
)

# Fixed values of the request rules.
MAX_ATTEMPTS = 3
EMPTY_ADDRESS, NO_RESULTS, RATE_LIMITED, NO_ATTEMPT, NO_ANSWER, UNREADABLE = (
    "empty address",
    "no results",
    "rate limited",
    "no attempt",
    "no answer",
    "unreadable answer: ",
)
# A log row is one request: the retry it belongs to, and within a retry the step,
# which counts the requests with fewer parameters. status is null, and reason the
# error's text, where no answer came.
LOG_KEY, LOG_ORDER = ("id", "address"), ("retry", "step")
# Parameters left out at each step after a request was refused with 400.
FALLBACK_STEPS = ((), ("language",), ("language", "idxSet"))
ITEMS_PER_BATCH, BATCHES_PER_WAVE = 10, 100
COUNTRY_CODE = "ZA"


def readable(body: str | Column = "body") -> Column:
    """Whether a body is one JSON value from its first to its last sign; an empty or
    missing one is not. As the only entry of a list it leaves no room for a rest."""
    entry = F.concat(F.lit("["), F.col(body) if isinstance(body, str) else body, F.lit("]"))
    return F.coalesce(F.json_array_length(entry) == 1, F.lit(False))


def succeeded() -> Column:
    """A readable answer below 400; a request that never got a status has failed.

    Only bodies of such answers are parsed.
    """
    return F.when(F.col("status") < 400, readable()).otherwise(F.lit(False))


def final_outcomes(
    attempts: DataFrame, key: Sequence[str] = LOG_KEY, order: Sequence[str] = LOG_ORDER
) -> DataFrame:
    """What the logged requests of each key came to: the first success, else the last failure.

    ``answered`` tells which; an answer that cannot be read is a failure.
    The log may hold any number of requests. Each map task sends one request of
    a key at most.
    """
    success = F.col("_answered")
    places = [F.when(success, F.col(c)).otherwise(-F.col(c)) for c in order]
    window = Window.partitionBy(*key).orderBy(success.desc(), *places)
    return (
        attempts.withColumn("_answered", succeeded())
        .withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .select(
            *key,
            *[F.col(c).alias(f"deciding_{c}") for c in order],
            success.alias("answered"),
            "status",
            "reason",
            "body",
            F.lit(True).alias("asked"),
        )
    )


def failure_text(max_text: int | None = None) -> Column:
    """Reason of a failed outcome, null for a success; bodies whole unless cut by ``max_text``."""
    status, text = F.col("status"), F.coalesce(F.col("body"), F.lit(""))
    if max_text is not None:
        text = F.substring(text, 1, max_text)
    return (
        F.when(status.isNull(), F.coalesce(F.col("reason"), F.lit(NO_ANSWER)))
        .when(status == 429, RATE_LIMITED)
        .when(
            status >= 400,
            F.concat(
                status.cast("string"), F.lit(" "), F.coalesce("reason", F.lit("")), F.lit(": "), text
            ),
        )
        .when(~F.col("answered"), F.concat(F.lit(UNREADABLE), text))
    )


def resolved_addresses(
    addresses: DataFrame, attempts: DataFrame, max_text: int | None = None
) -> DataFrame:
    """Every address of every id with its outcome and, where it has none, the reason why."""
    source = addresses.select(
        F.col("id").cast("string").alias("id"), F.col("address").alias("inputAddress")
    ).distinct()
    outcomes = final_outcomes(attempts.withColumn("id", F.col("id").cast("string")))
    empty = F.coalesce(F.col("inputAddress"), F.lit("")) == ""
    reason = (
        F.when(empty, EMPTY_ADDRESS)
        .when(F.col("asked").isNull(), NO_ATTEMPT)
        .otherwise(failure_text(max_text))
    )
    found = outcomes.withColumnRenamed("address", "inputAddress")
    return source.join(found, ["id", "inputAddress"], "left").withColumn("error", reason)


def _results(body: Column) -> Column:
    """Candidates in the response; entries that are no objects are left out."""
    return F.array_compact(F.from_json(body, GEOCODE_RESPONSE)["results"])


def _candidate_fields(candidate: Column, rank: Column, error: Column) -> list[Column]:
    address, position = candidate["address"], candidate["position"]
    values = {
        "id": F.col("id"),
        "inputAddress": F.col("inputAddress"),
        "score": candidate["score"],
        "scoreRank": rank,
        **{
            name: address[name]
            for name in (
                "freeformAddress",
                "countryCode",
                "municipality",
                "streetName",
                "postalCode",
            )
        },
        "lat": position["lat"],
        "lon": position["lon"],
        "matchType": candidate["type"],
        "error": error,
    }
    return [values[name].alias(name) for name in GEOCODE_COLUMNS]


def geocode_candidates(resolved: DataFrame) -> DataFrame:
    """One row per candidate; one row with the reason for an address without any."""
    succeeded = F.when(F.col("error").isNull(), _results(F.col("body")))
    opened = resolved.select("id", "inputAddress", "error", F.posexplode_outer(succeeded))
    reason = F.coalesce("error", F.when(F.col("col").isNull(), NO_RESULTS))
    return opened.select(*_candidate_fields(F.col("col"), F.col("pos") + 1, reason))


def best_candidates(candidates: DataFrame) -> DataFrame:
    """Best-ranked candidate per id, rows without a rank last."""
    return keep_earliest(candidates, ["id"], ["scoreRank"], ["inputAddress", "freeformAddress"])


def best_matches(resolved: DataFrame) -> DataFrame:
    """Best candidate of each id, without opening the others.

    Ranks count from the first candidate, so the first is the best of its
    address: the rows need not be multiplied. Of an id's addresses the one with
    a match goes first.
    """
    first = F.get(F.when(F.col("error").isNull(), _results(F.col("body"))), F.lit(0))
    opened = resolved.select("id", "inputAddress", "error", first.alias("candidate"))
    reason = F.coalesce("error", F.when(F.col("candidate").isNull(), NO_RESULTS))
    rank = F.when(F.col("candidate").isNotNull(), F.lit(1))
    return best_candidates(opened.select(*_candidate_fields(F.col("candidate"), rank, reason)))


def fallback_parameters(attempts: DataFrame, parameters: Mapping[str, str]) -> DataFrame:
    """Parameters of each logged request: fewer after each refusal with status 400.

    Every retry starts from all parameters again. Only as many refusals as there
    are steps matter, so no retry brings more than those into one place.
    """
    last = len(FALLBACK_STEPS) - 1
    of_retry = ["id", "address", "retry"]
    refusals = attempts.filter(F.col("status") == 400).select(*of_retry, "step").distinct()
    place = F.row_number().over(Window.partitionBy(*of_retry).orderBy("step"))
    first_refusals = (
        refusals.withColumn("_place", place)
        .filter(F.col("_place") <= last)
        .groupBy(*of_retry)
        .agg(F.collect_list("step").alias("_refused_at"))
    )
    earlier = F.filter("_refused_at", lambda refused: refused < F.col("step"))
    full = F.create_map(*[F.lit(x) for pair in sorted(parameters.items()) for x in pair])
    dropped = F.array(
        *[F.array(*[F.lit(name) for name in step]).cast("array<string>") for step in FALLBACK_STEPS]
    )
    sent = F.map_filter(
        full, lambda name, _: ~F.array_contains(F.get(dropped, F.col("fallback_step")), name)
    )
    return (
        attempts.join(first_refusals, of_retry, "left")
        .withColumn("fallback_step", F.coalesce(F.size(earlier), F.lit(0)))
        .withColumn("parameters", F.to_json(sent))
        .select(*attempts.columns, "fallback_step", "parameters")
    )


def request_items(geocoded: DataFrame, buffer_metres: int = DEFAULT_BUFFER_METRES) -> DataFrame:
    """Id, point and buffer of every address with both coordinates."""
    buffer = checked_buffer(buffer_metres)
    return geocoded.dropna(subset=["lat", "lon"]).select(
        F.col("id").cast("string").alias("id"),
        point_text(F.col("lon"), F.col("lat")).alias("wkt_geometry"),
        F.lit(buffer).alias("buffer"),
    )


def request_batches(
    items: DataFrame,
    items_per_batch: int = ITEMS_PER_BATCH,
    batches_per_wave: int = BATCHES_PER_WAVE,
    max_waves: int | None = None,
) -> DataFrame:
    """Request bodies of ten items, numbered within waves of a hundred bodies.

    A wave is what one call may send. With ``max_waves`` a larger set is
    refused, otherwise it runs in as many waves as it needs. Repeated items
    are asked for once.
    """
    numbered = number_rows(items.distinct(), ["id", "wkt_geometry", "buffer"], "item")
    batch = F.floor((F.col("item") - 1) / items_per_batch)
    grouped = numbered.groupBy(batch.alias("_batch")).agg(
        F.sort_array(F.collect_list(F.struct("item", "id", "wkt_geometry", "buffer"))).alias("i")
    )
    wave = F.floor(F.col("_batch") / batches_per_wave)
    if max_waves is not None:
        limit = items_per_batch * batches_per_wave * max_waves
        refusal = F.raise_error(F.lit(f"too many items: at most {limit}"))
        wave = F.when(wave < max_waves, wave).otherwise(refusal.cast("bigint"))
    geometries = F.transform("i", lambda x: F.struct(x["id"], x["wkt_geometry"], x["buffer"]))
    request = F.struct(
        F.lit(COUNTRY_CODE).alias("country_code"), geometries.alias("geometries")
    )
    return grouped.select(
        (wave + 1).cast("int").alias("wave"),
        (F.col("_batch") % batches_per_wave + 1).cast("int").alias("batch"),
        F.size("i").alias("item_count"),
        F.to_json(request).alias("body"),
    )


def _is_list() -> Column:
    """Whether a body is a readable list; null bodies are not."""
    return readable() & F.coalesce(F.startswith(F.ltrim("body"), F.lit("[")), F.lit(False))


def unreadable_responses(responses: DataFrame, max_text: int | None = None) -> DataFrame:
    """Dead letters: the responses whose body is no list of answers, with the reason.

    Each response row is either here or opened by ``flat_depths`` and
    ``flat_scores``, never partly both. All columns are kept.
    """
    text = F.coalesce("body", F.lit(""))
    if max_text is not None:
        text = F.substring(text, 1, max_text)
    return responses.filter(~_is_list()).withColumn("error", F.concat(F.lit(UNREADABLE), text))


def _opened(responses: DataFrame, schema: T.ArrayType) -> DataFrame:
    items = F.array_compact(F.when(_is_list(), F.from_json("body", schema)))
    return responses.select("batch_id", F.posexplode(items).alias("position", "item"))


def flat_depths(responses: DataFrame) -> DataFrame:
    """Depth responses as one wide row per item: 61 named statistics."""
    return _opened(responses, flood_depth_schema()).select(
        "batch_id",
        "position",
        F.col("item.id").alias("address_id"),
        *[F.col(f"item.{path}").alias(name) for path, name in flood_depth_paths().items()],
    )


def flat_scores(responses: DataFrame) -> DataFrame:
    """Score responses as one row per item: 7 named scores."""
    return _opened(responses, flood_score_schema()).select(
        "batch_id",
        "position",
        F.col("item.id").alias("address_id"),
        *[F.col(f"item.{name}").alias(alias) for name, alias in FLOOD_SCORE_NAMES.items()],
    )


def first_per_address(items: DataFrame) -> DataFrame:
    """First answer of each address, in the order of batches and positions."""
    return keep_earliest(items, ["address_id"], ["batch_id", "position"]).drop(
        "batch_id", "position"
    )


def merge_depths_and_scores(
    depths: DataFrame, scores: DataFrame, when_one_side_empty: str = "nothing"
) -> DataFrame:
    """Addresses with both answers, first answers only.

    Repeated answers are reduced before the join, which keeps the same row as
    joining all pairs and keeping the first. ``when_one_side_empty="other"``
    returns the other side alone if a whole side holds no answer at all; one
    stray answer there is enough to leave addresses without it out.
    """
    if when_one_side_empty not in ("nothing", "other"):
        raise ValueError("when_one_side_empty is 'nothing' or 'other'")
    d, s = first_per_address(depths), first_per_address(scores)
    both = d.join(s, "address_id")
    if when_one_side_empty == "nothing":
        return both
    no_depths = depths.limit(1).agg(F.count("*") == 0).scalar()
    no_scores = scores.limit(1).agg(F.count("*") == 0).scalar()
    return both.unionByName(d.filter(no_scores), allowMissingColumns=True).unionByName(
        s.filter(no_depths), allowMissingColumns=True
    )


def batch_outcomes(
    requests: DataFrame, log: DataFrame, key: Sequence[str] = ("wave", "batch"),
    max_text: int | None = None,
) -> DataFrame:
    """Every request batch with what its logged requests came to.

    Key columns, answered, deciding_retry, status, body (of the answer) and error:
    ``[batch i/n] status reason: text`` where the batch failed for good, the
    reason alone where no answer came, ``no attempt`` where none is logged.
    Batches are told apart by their key, and n is the number of them.
    """
    names = list(key)
    asked = requests.select(*names).distinct()
    outcomes = final_outcomes(log, names, ["retry"])
    total = asked.agg(F.count("*").cast("string")).scalar()
    place = F.concat(
        F.lit("[batch "), F.concat_ws(".", *[F.col(c).cast("string") for c in names]),
        F.lit("/"), total, F.lit("] "),
    )
    answered = F.coalesce("answered", F.lit(False))
    error = F.when(F.col("asked").isNull(), NO_ATTEMPT).when(
        ~answered, F.concat(place, failure_text(max_text))
    )
    return asked.join(outcomes, names, "left").select(
        *names,
        answered.alias("answered"),
        "deciding_retry",
        "status",
        F.when(answered, F.col("body")).alias("body"),
        error.alias("error"),
    )


def require_answered(outcomes: DataFrame) -> DataFrame:
    """The outcomes of ``batch_outcomes``; stops where a batch failed for good."""
    failed = outcomes.filter(~F.col("answered")).select("error").head()
    if failed is not None:
        raise RuntimeError(f"a batch has no answer: {failed.error}")
    return outcomes


def enrich_partitions(
    df: DataFrame,
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    batch_size: int = ITEMS_PER_BATCH,
    max_attempts: int = MAX_ATTEMPTS,
    retryable: Callable[[Exception], bool] = lambda error: isinstance(error, OSError),
    wait_seconds: float = 0.75,
    error_column: str = "error",
) -> DataFrame:
    """Rows answered by a function of the caller, ten at a time, on the executors.

    A batch that fails with a retryable error (by default those of transport) is
    asked again after a wait that grows with each try. One that keeps failing
    gives its rows with the columns they came with, and the error's text in
    ``error_column``, which the schema must name. Any other error ends the job.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    if error_column not in names:
        raise ValueError(f"the schema has no column {error_column}")

    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        for attempt in range(1, max_attempts + 1):
            try:
                return fetch(batch).assign(**{error_column: None})[names]
            except Exception as error:
                if not retryable(error):
                    raise
                if attempt == max_attempts:
                    kept = {c: batch[c] if c in batch else None for c in names}
                    return pd.DataFrame({**kept, error_column: str(error)}, index=batch.index)
                time.sleep(wait_seconds * attempt)
        raise AssertionError("unreachable")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield answer(frame.iloc[start : start + batch_size])

    return df.mapInPandas(run, schema)
