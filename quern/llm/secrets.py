"""Operator 3: secrets, with credentials of several parts linked (native).

Only DataFrame functions: a regular expression's matches come from
``regexp_extract_all`` and their places from the lengths of what ``split``
leaves between them, summed by a window.  Parts of a credential (access
identifier, secret, endpoint) are joined by interval within a document, through
cells of the scope's width that are aggregated first: the join's rows grow with
the parts, not with their pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.store import materialize, table


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
_VALUE = "[A-Za-z0-9+/_.=-]+"
_KEY40 = "[A-Za-z0-9+/]"
_HOST = "[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,126}"  # as long as names of hosts can be


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str  # group 1 is what the least length and ``needs`` are about
    least: int
    base: bool
    needs: tuple[str, ...] = ()  # patterns that group 1 must also hold
    partners: tuple[str, ...] = ()  # a weak kind counts only with one of these in its scope, a weak one only if it counts itself


KINDS = (
    Kind("assign", _NAMES + "[\"']?\\x20*[:=]\\x20*[\"']?(" + _VALUE + ")", 6, True),
    Kind("access", "(AKIA[A-Z0-9]+)", 20, True),
    Kind("hex", "([0-9a-f]{24,})", 24, True),  # a run of at least 24 is the whole run
    Kind("key", f"(?<!{_KEY40})({_KEY40}{{40}})(?!{_KEY40}|=)", 40, False, ("[0-9]", "[A-Z]", "[a-z]"), ("access", "endpoint")),
    Kind("endpoint", f"(?<![A-Za-z0-9.-])((?:https?://{_HOST}(?::[0-9]{{1,5}})?)|(?:[a-z0-9-]{{1,63}}(?:\\.[a-z0-9-]{{1,63}}){{0,4}}\\.amazonaws\\.com))", 8, False, (), ("access", "assign")),
)
_NUMBER = {k.name: i for i, k in enumerate(KINDS)}
_BASE = sum(k.base for k in KINDS)


@dataclass(frozen=True)
class SecretConfig:
    scope: int = 400  # code points between the starts of parts that make one credential


def _found(text: Column, kind: Kind) -> Column:
    """array<struct<gap, found, size>>: code points before each leftmost match (from the
    last one's end), in it, and in its group 1 (0 if the match fails)."""
    length = lambda x: F.length(x).cast("int")
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1))
    fits = lambda x: reduce(lambda c, p: c & x.rlike(p), kind.needs, F.length(x) >= kind.least)
    gaps = F.slice(F.transform(F.split(text, kind.pattern, -1), length), 1, F.size(whole))
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(whole, length).alias("found"), F.transform(part, lambda x: F.when(fits(x), length(x)).otherwise(0)).alias("size"))
    triples = F.transform(zipped, lambda x: F.struct(x["gap"].alias("gap"), x["found"].alias("found"), x["size"].alias("size")))
    return F.when(text.rlike(kind.pattern), triples)


def _with_partners(weak: DataFrame, counted: DataFrame, kind: Kind, scope: int) -> DataFrame:
    """The parts of a weak kind with a partner among ``counted`` whose start is at most ``scope`` away."""
    cell = F.floor(F.col("start") / scope)
    partners = counted.where(F.col("kind").isin([_NUMBER[p] for p in kind.partners]))
    cells = partners.groupBy(F.col("rid").alias("r"), cell.alias("cell")).agg(F.min("start").alias("low"), F.max("start").alias("high"))
    weak = weak.withColumn("near", F.explode(F.array(cell - 1, cell, cell + 1)))
    met = (weak.rid == cells.r) & (weak.near == cells.cell)
    inside = (F.col("high") >= F.col("start") - scope) & (F.col("low") <= F.col("start") + scope)
    return weak.join(cells, met & inside, "left_semi").drop("near").distinct()


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, config: SecretConfig = SecretConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, spans
    (array of kind, start, end by start then kind; code points, end exclusive).

    * base kinds (assign, access, hex): leftmost non-overlapping matches; those
      whose value is too short are dropped without a new try.
    * an endpoint counts only with an access identifier or an assignment in its scope,
      a string like a secret key only with an access identifier or an endpoint that counts.
    * very long texts: the whole text counts.  Ties: spans of different kinds may be
      equal or overlap, each is reported; a partner exactly ``scope`` away is one.
    * null or empty text: no spans.  Null ids and repeated rows are kept as they are;
      an empty table gives no rows; further columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), *[_found(text, k).alias(k.name) for k in KINDS])
    read = materialize(read, "secrets")
    some = read.where(reduce(lambda a, b: a | b, [F.col(k.name).isNotNull() for k in KINDS]))
    matches = reduce(DataFrame.unionAll, [some.where(F.col(k.name).isNotNull()).select("rid", F.lit(i).alias("kind"), F.posexplode(k.name).alias("i", "m")) for i, k in enumerate(KINDS)])
    end = F.sum(F.col("m.gap").cast("long") + F.col("m.found")).over(Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    parts = matches.select("rid", "kind", "m", end.alias("end")).where("m.size > 0").select("rid", "kind", (F.col("end") - F.col("m.found")).alias("start"), "end")
    parts = materialize(parts, "parts")
    spans = parts.where(F.col("kind") < _BASE)
    for kind in sorted((k for k in KINDS if not k.base), key=lambda k: any(not KINDS[_NUMBER[p]].base for p in k.partners)):
        spans = spans.unionAll(_with_partners(parts.where(F.col("kind") == _NUMBER[kind.name]), spans, kind, config.scope))
    counted = [F.count_if(F.col("kind") == i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base]
    by_row = spans.groupBy(F.col("rid").alias("r")).agg(*counted, F.collect_list(F.struct("start", "kind", "end")).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = read.select("rid", "doc_id").join(by_row, F.col("rid") == F.col("r"), "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base], F.coalesce("spans", none).alias("spans"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < _BASE)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
