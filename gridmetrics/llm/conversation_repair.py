"""Finding faults in conversations, and the cheapest edits that repair them.

A message is blank (no character but white space), a duplicate (role and text seen earlier in the
conversation) or truncated (its last such character is no closing mark); the first of these that holds
counts. Edits and their costs are those of :mod:`gridmetrics.llm.audit_paths`.

Messages without their texts (digests instead) are dealt out by range, in the order of
conversations and turns, so that a conversation of any length is spread over tasks. Each
task runs the audit DP over its stretches: for the states in which a stretch may begin, the best edits up
to each state after it. One row a stretch is left; those of a conversation are put together in order. The
letters then go to the messages, which pass through a task in order, conversation by conversation, and come
out repaired. No task holds the messages of a conversation: a hash of a whole one is by nature computed in
order, so its texts stream through one task, and its letters, one byte a message, are held there, as they
are in the result.

Null turns come first. Null roles, texts and conversations count as one space; the null conversation stays
one of its own. Messages with one turn are ordered by role and digest of the text. Repeated rows are duplicates of
each other. Texts of any length pass; extra columns may have any names. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmetrics.llm import audit_paths
from gridmetrics.llm.audit_paths import DELETE, INSERT, MUST_GO, REROLE, STATES
from gridmetrics.llm.batches import bound_batches
from gridmetrics.llm.storage import checkpointed
from gridmetrics.operators.positions import null_safe_join

#: Messages of one stretch at most; a longer conversation has several, also in one task.
STRETCH = 16_384
#: Best edits of short stretches that a worker remembers, and the longest of them.
KEPT_STRETCHES, KEPT_LENGTH = 50_000, 24

_NOT_SPACE = r"[^\x20\x09-\x0D]"
_LEGAL = {"su", "ua", "au"}


def messages(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None) -> DataFrame:
    """Columns ``conv``, ``turn``, ``role``, ``text``, ``digest`` and ``copies`` (how often the row counts)."""
    named = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    return named.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]


def _faults(said: DataFrame) -> DataFrame:
    """Equal messages of a turn as one row, with ``kind`` (blank, duplicate, truncated or good) of the first of its ``copies``."""
    # A string of its last character that is not white space, or empty.
    last = F.regexp_extract("text", rf"({_NOT_SPACE})[\x20\x09-\x0D]*\z", 1)
    kinds = F.when(last == "", "blank").when(last.isin(".", "!", "?"), "good").otherwise("truncated")
    told = said.select("conv", "turn", "role", "digest", "copies", kinds.alias("kind"))
    told = told.groupBy("conv", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("kind").alias("kind"))
    told = checkpointed(told)
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    earliest = told.where("kind <> 'blank'").groupBy("conv", "role", "digest").agg(F.min(place).alias("_earliest"))
    joined = null_safe_join(told, earliest, ["conv", "role", "digest"], "left")
    later = (F.col("kind") != "blank") & (place != F.col("_earliest"))
    return joined.withColumn("kind", F.when(later, F.lit("duplicate")).otherwise(F.col("kind"))).drop("_earliest")


@dataclass
class _Stretch:
    """Messages in a row, of one conversation, in one task."""

    conv: Any
    number: int
    begins: bool
    codes: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated"), 0))
    illegal: int = 0
    turns: int = 0
    initials: list[str | None] = field(default_factory=list)
    bounds: list[int | None] = field(default_factory=lambda: [None, None])
    length: int = 0

    def add(self, turn: int | None, initial: str, kind: str, copies: int) -> None:
        """Equal messages of a turn; all but the first are duplicates, unless they are blank."""
        if self.initials:
            self.illegal += self.initials[-1] + initial not in _LEGAL
            self.initials[-1] = initial
        else:
            self.initials = [initial, initial]
        self.illegal += copies - 1  # no role may follow itself
        if turn is not None and turn != self.bounds[1]:
            self.turns += 1
            self.bounds = [turn if self.bounds[0] is None else self.bounds[0], turn]
        code = initial if initial in "sua" and initial else "o"
        first = {"good": code, "truncated": code.upper()}.get(kind, MUST_GO)
        if kind != "good":
            self.counts[kind] += 1
        self.counts["blank" if kind == "blank" else "duplicate"] += copies - 1
        self.codes.append(first + MUST_GO * (copies - 1))
        self.length += copies

    def row(self, edits: Callable[[str, int | None], audit_paths.Edits]) -> tuple:
        codes = "".join(self.codes)
        starts = [None] if self.begins else STATES
        ways = [
            {"before": -1 if state is None else state, "after": after, "cost": cost, "letters": letters}
            for state in starts
            for after, (cost, letters) in edits(codes, state).items()
        ]
        counts = [self.counts[kind] for kind in ("blank", "duplicate", "truncated")]
        return (self.conv, TaskContext.get().partitionId(), self.number, *counts, self.illegal, self.turns, *self.bounds, *self.initials, ways)


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_SUMMARY = (
    "part int, number int, blank long, duplicate long, truncated long, illegal long, turns long, min_turn long, max_turn long, "
    "first_initial string, last_initial string, ways array<struct<before int, after int, cost long, letters string>>"
)


def _stretches(told: DataFrame) -> DataFrame:
    """A row for each stretch of a conversation in a task."""
    ordered = told.select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "kind", "copies", "role", "digest")
    ordered = ordered.repartitionByRange(*_order()).sortWithinPartitions(*_order()).select("conv", "turn", "initial", "kind", "copies")
    kind = ordered.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, int | None], audit_paths.Edits] = {}
        now: _Stretch | None = None
        schema = None

        def edits(codes: str, state: int | None) -> audit_paths.Edits:
            if len(codes) > KEPT_LENGTH:
                return audit_paths.edits_from(codes, state)
            if (codes, state) not in known:
                if len(known) >= KEPT_STRETCHES:
                    known.clear()
                known[codes, state] = audit_paths.edits_from(codes, state)
            return known[codes, state]

        def closed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            schema = schema or _summary_schema(batch.column(0).type)
            rows = []
            for conv, turn, initial, fault, copies in zip(*(column.to_pylist() for column in batch.columns)):
                while copies:
                    if now is None or conv != now.conv or now.length >= STRETCH:
                        # Only the first conversation of a task may have begun in another.
                        number = 0 if now is None else now.number + 1
                        begins = now is not None and conv != now.conv
                        if now is not None:
                            rows.append(now.row(edits))
                        now = _Stretch(conv, number, begins)
                    some = min(copies, STRETCH - now.length)
                    now.add(turn, initial, fault, some)
                    copies -= some
                    fault = "blank" if fault == "blank" else "duplicate"
                if len(rows) >= 2000:
                    yield closed(rows)
                    rows = []
            if rows:
                yield closed(rows)
        if now is not None:
            yield closed([now.row(edits)])

    bound_batches(ordered)
    return ordered.mapInArrow(run, f"conv {kind}, {_SUMMARY}")


def _summary_schema(conv: pa.DataType) -> pa.Schema:
    longs, texts = pa.int64(), pa.string()
    way = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", longs), ("letters", texts)])
    kinds = [pa.int32(), pa.int32(), *[longs] * 7, texts, texts, pa.list_(way)]
    names = [column.split()[0] for column in _SUMMARY.split(", ways")[0].split(", ")] + ["ways"]
    return pa.schema([("conv", conv), *zip(names, kinds)])


class _Conversation:
    """The stretches of a conversation, put together in order."""

    def __init__(self, conv: Any) -> None:
        self.conv, self.ways = conv, audit_paths.start()
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.turns, self.min_turn, self.max_turn, self.last = 0, None, None, None

    def add(self, row: dict) -> None:
        steps: dict[int, audit_paths.Edits] = {}
        for way in row["ways"]:
            steps.setdefault(way["before"], {})[way["after"]] = (way["cost"], way["letters"])
        self.ways = audit_paths.begun(steps[-1]) if -1 in steps else audit_paths.followed_by(self.ways, steps)
        for name in _COUNTS:
            self.counts[name] += row[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + row["first_initial"] not in _LEGAL
        self.last = row["last_initial"]
        if row["turns"]:
            self.turns += row["turns"] - (self.max_turn == row["min_turn"])
            self.min_turn = row["min_turn"] if self.min_turn is None else self.min_turn
            self.max_turn = row["max_turn"]

    def row(self) -> tuple:
        gaps = self.max_turn - self.min_turn + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.counts.values(), *audit_paths.chosen(self.ways))


def _streamed(df: DataFrame, run: Callable[[Iterator[dict]], Iterator[tuple]], kinds: list[pa.DataType | None], schema: str) -> DataFrame:
    """Rows of a task, in order and one by one, through ``run``; a kind of None is that of the first column."""
    names = [column.strip().split()[0].strip("`") for column in schema.split(",")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.DataType] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                seen.append(batch.column(0).type)
                yield from batch.to_pylist()
                del seen[1:]

        def closed(done: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(column, kind or seen[0]) for column, kind in zip(zip(*done), kinds)]
            return pa.RecordBatch.from_arrays(columns, names)

        done, size = [], 0
        for row in run(rows()):
            done.append(row)
            size += sum(len(value) for value in row if isinstance(value, str))
            if len(done) >= 2000 or size >= 1 << 23:
                yield closed(done)
                done, size = [], 0
        if done:
            yield closed(done)

    bound_batches(df)
    return df.mapInArrow(work, schema)


def audits(said: DataFrame) -> DataFrame:
    """Per conversation with messages: ``conv``, ``gaps``, counts of faults, ``illegal``, ``cost`` and ``audit``."""
    parts = _stretches(_faults(said))
    parts = parts.repartition("conv").sortWithinPartitions("conv", "part", "number")

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        now = None
        for row in rows:
            if now is None or row["conv"] != now.conv:
                if now is not None:
                    yield now.row()
                now = _Conversation(row["conv"])
            now.add(row)
        if now is not None:
            yield now.row()

    kind = parts.schema["conv"].dataType.simpleString()
    longs = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return _streamed(parts, run, [None, *[pa.int64()] * 6, pa.string()], f"conv {kind}, {longs}, audit string")


def _replayed(rows: Iterator[dict]) -> Iterator[tuple[Any, str | None, str | None, str | None, int | None]]:
    """Conversation, edit, role, text and turn of what the letters leave; a begin has none of the four.

    A conversation comes as its letters and then its messages.
    """
    audit, at, said, conv, system = "", 0, 0, None, False

    def following() -> str:
        return "user" if (said - system) % 2 == 0 else "assistant"

    def inserted() -> Iterator[tuple]:
        nonlocal at, said
        while at < len(audit) and audit[at] == INSERT:
            yield conv, INSERT, following(), "", None
            at, said = at + 1, said + 1

    for row in rows:
        if row["audit"] is not None:
            yield from inserted()
            audit, at, said, conv, system = row["audit"], 0, 0, row["conv"], False
            yield conv, None, None, None, None
            continue
        for _ in range(row["copies"]):
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit == DELETE:
                continue
            role = following() if edit == REROLE else row["role"]
            if said == 0 and edit != REROLE and role[:1] == "s":
                system = True
            yield conv, edit, role, row["text"], row["turn"]
            said += 1
    yield from inserted()


def _with_letters(said: DataFrame, audited: DataFrame) -> DataFrame:
    """The letters of each conversation and then its messages, in order."""
    kinds = {f.name: f.dataType for f in said.schema}
    empty = {name: F.lit(None).cast(kinds[name]).alias(name) for name in ("turn", "role", "text", "digest", "copies")}
    first = audited.select("conv", "audit", *empty.values())
    both = first.unionByName(said.select("conv", F.lit(None).cast("string").alias("audit"), *empty))
    return both.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), *_order()[1:])


def repaired_messages(said: DataFrame, audited: DataFrame) -> DataFrame:
    """The messages that are left: ``conv``, ``place`` from 0, ``turn`` (null for an inserted one), ``role``, ``text``, ``edit``."""
    rows = _with_letters(said, audited)

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        place = 0
        for conv, edit, role, text, turn in _replayed(rows):
            if edit is None:
                place = 0
                continue
            yield conv, place, turn, role, text, edit
            place += 1

    kind = rows.schema["conv"].dataType.simpleString()
    texts = pa.string()
    return _streamed(rows, run, [None, pa.int64(), pa.int64(), texts, texts, texts], f"conv {kind}, place long, turn long, role string, text string, edit string")


def repaired_digests(said: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv`` and ``repaired_sha256`` of its repaired messages, ``role:text``, joined by newlines."""
    rows = _with_letters(said, audited)

    def run(rows: Iterator[dict]) -> Iterator[tuple]:
        state: tuple | None = None
        for conv, edit, role, text, _ in _replayed(rows):
            if edit is None:
                if state is not None:
                    yield state[0], state[1].hexdigest()
                state, between = (conv, sha256()), ""
                continue
            state[1].update(f"{between}{role}:{text}".encode())
            between = "\n"
        if state is not None:
            yield state[0], state[1].hexdigest()

    kind = rows.schema["conv"].dataType.simpleString()
    return _streamed(rows, run, [None, pa.string()], f"conv {kind}, repaired_sha256 string")


def repair_report(rows: DataFrame, said: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """A row for every conversation of ``rows``: what is wrong with its messages ``said``, the letters, the repaired digest.

    A conversation without messages has zeros, no letters and the digest of an empty text.
    """
    audited = checkpointed(audits(said))
    digests = repaired_digests(said, audited)
    every = rows.select(F.col(conversation).alias("conv")).distinct()
    joined = null_safe_join(null_safe_join(every, audited, ["conv"], "left"), digests, ["conv"], "left")
    numbers = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", *_COUNTS, "cost")]
    digest = F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256")
    return joined.select(F.col("conv").alias(conversation), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), digest)
