"""Secrets in texts: patterns that are enough by themselves, and credentials linked from several parts.

Assignments, access ids and long hexadecimal runs count wherever they stand. A random-looking string is
only a weak candidate. A join with the access ids and endpoints of the same scope (a paragraph) reports
it if there is one, however far away: the scope is the interval in which parts complement each other. A
random-looking string inside an endpoint is complemented by that endpoint.

Texts are searched once, in Arrow batches; what is found goes to the checkpoint folder. The join is on
text and scope, with one row for each scope that has an access id or endpoint.

Null text counts as empty. Result rows come out for each input row; repeated rows get the same result,
and so do rows with a null id. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from gridmetrics.llm.batches import bound_batches, map_batches
from gridmetrics.llm.storage import checkpointed

#: Kinds in the order in which spans that begin together are listed (fixed values).
KINDS = ("assign", "access", "hex", "linked")

#: Patterns that are enough by themselves (fixed values). Case does not count in the first, for ASCII letters.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
SHORTEST_ASSIGNED = 12

#: Parts: endpoints, further access ids, and strings that may be secrets.
ENDPOINT = re.compile(r"(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s\"'<>]{4,}")
IDENTIFIER = re.compile(r"""(?:client|access|account|user)_?(?:key_?)?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}""", re.ASCII | re.IGNORECASE)
WEAK = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

#: What ends a scope.
SCOPE_END = re.compile(r"\n[ \t]*\n")

MASK = "[secret]"

_PART = pa.struct([("scope", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """Start, kind and end of what counts by itself, by start and then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def looks_random(value: str) -> bool:
    """Whether a string mixes lower case, upper case and digits, and does not repeat few characters."""
    return any(map(str.islower, value)) and any(map(str.isupper, value)) and any(map(str.isdigit, value)) and len(set(value)) >= 10


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as spans in order that do not overlap."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def text_parts(text: str, base: list[tuple[int, str, int]]) -> tuple[list[dict], list[dict]]:
    """Weak candidates outside the base spans and access ids, and access ids and endpoints, with their scopes."""
    weak = [(m.start(), m.end()) for m in WEAK.finditer(text) if looks_random(m[0])]
    if not weak:
        return [], []
    known = [(start, end) for start, kind, end in base if kind == "access"]
    named = [m.span() for m in IDENTIFIER.finditer(text)]
    others = known + [m.span() for m in ENDPOINT.finditer(text)] + named
    taken = merged_spans([(start, end) for start, _, end in base] + named)
    begins = [start for start, _ in taken]

    def free(start: int, end: int) -> bool:
        at = bisect_left(begins, end) - 1  # the last that begins before the end
        return at < 0 or taken[at][1] <= start

    weak = [span for span in weak if free(*span)]
    ends = [m.start() for m in SCOPE_END.finditer(text)]
    part = lambda span: {"scope": bisect_left(ends, span[0]), "start": span[0], "end": span[1]}
    return [part(s) for s in weak], [part(s) for s in others]


def _found(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    source = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, weak, parts = [], [], []
        for value in batch.column(2):
            found = base_spans(value.as_py())
            spans.append([{"start": start, "kind": KINDS.index(kind), "end": end} for start, kind, end in found])
            for column, some in zip((weak, parts), text_parts(value.as_py(), found), strict=True):
                column.append(some)
        base = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:2], base, pa.array(weak, pa.list_(_PART)), pa.array(parts, pa.list_(_PART))], ["id", "print", "base", "weak", "parts"]
        )

    part = "array<struct<scope: int, start: int, end: int>>"
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, search, f"id {kind}, print long, base array<struct<start: int, kind: int, end: int>>, weak {part}, parts {part}")


def _linked(found: DataFrame) -> DataFrame:
    """Weak candidates with an access id or endpoint in their scope."""
    rows = found.where(F.size("weak") > 0).where(F.size("parts") > 0)
    weak = rows.select("id", "print", F.explode("weak").alias("part")).select("id", "print", "part.*").alias("w")
    scopes = F.explode(F.array_distinct(F.transform("parts", lambda p: p["scope"])))
    other = rows.select("id", "print", scopes.alias("scope")).distinct().alias("o")
    same = F.col("w.id").eqNullSafe(F.col("o.id"))
    for name in ("print", "scope"):
        same = same & (F.col(f"w.{name}") == F.col(f"o.{name}"))
    spans = weak.join(other, same, "left_semi").select("id", "print", "start", F.lit(KINDS.index("linked")).alias("kind"), "end")
    return spans.groupBy("id", "print").agg(F.collect_set(F.struct("start", "kind", "end")).alias("linked"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``print`` (a hash of the text), ``base`` and ``found``, both arrays of (start, kind, end) in order."""
    found = checkpointed(_found(docs, id_column, text_column))
    linked = _linked(found).withColumnsRenamed({"id": "linked_id", "print": "linked_print"})
    same = F.col("id").eqNullSafe(F.col("linked_id")) & (F.col("print") == F.col("linked_print"))
    nothing = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    every = F.array_sort(F.concat("base", F.coalesce(F.col("linked"), nothing)))
    return found.join(linked, same, "left").select(F.col("id").alias(id_column), "print", "base", every.alias("found"))


def _number(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, numbers of base spans by kind, ``base_sha256`` of their list, and the list of all ``spans``."""
    spans = secret_spans(docs, id_column, text_column)
    counts = [_number(kind).alias(f"n_{KINDS[kind]}") for kind in range(3)]
    return spans.select(id_column, *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def masked_text(text: str, spans: list) -> str:
    """``text`` with each stretch that spans cover replaced by the mask."""
    parts, at = [], 0
    for start, end in spans:
        if start > at or not parts:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def without_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every secret masked; texts without one are left as they are."""
    spans = secret_spans(docs, id_column, text_column).where(F.size("found") > 0)
    spans = spans.select(F.col(id_column).alias("_secret_id"), F.col("print").alias("_secret_print"), F.col("found").alias("_secret_spans"))
    spans = spans.dropDuplicates(["_secret_id", "_secret_print"])

    @pandas_udf("string")
    def mask(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([masked_text(text, [(s["start"], s["end"]) for s in found]) for text, found in zip(texts, lists, strict=True)])

    text = F.col(text_column)
    bound_batches(docs)
    same = F.col(id_column).eqNullSafe(F.col("_secret_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_secret_print"))
    joined = docs.join(spans, same, "left")
    some = F.col("_secret_spans").isNotNull()
    masked = joined.where(some).withColumn(text_column, mask(text, F.col("_secret_spans")))
    return joined.where(~some).unionByName(masked).select(docs.columns)
