"""Conversation repair against enumerated edits and a plain reading of the rules."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmetrics.llm import audit_paths, conversation_repair, queries

LEGAL = re.compile(r"(s?(ua)+)?\Z")
LEGAL_BEGIN = re.compile(r"(s?(ua)*u?)?\Z")
CODES = st.text(st.sampled_from("xsuaoSUAO"), max_size=5)


def cheapest(codes):
    """Cost and letters of the cheapest edits, all of them tried."""
    best = None

    def go(at, roles, cost, letters):
        nonlocal best
        for extra in ("", "u", "a", "ua", "au"):
            said, paid, told = roles + extra, cost + 5 * len(extra), letters + "I" * len(extra)
            if not LEGAL_BEGIN.match(said) or best and paid > best[0]:
                continue
            if at == len(codes):
                if LEGAL.match(said) and (best is None or (paid, told) < best):
                    best = (paid, told)
                continue
            go(at + 1, said, paid + 2, told + "D")
            code = codes[at]
            if code != "x":
                kept = paid + (0 if code.islower() else 5)
                if code.lower() != "o":
                    go(at + 1, said + code.lower(), kept, told + "K")
                for role in "ua":
                    go(at + 1, said + role, kept + 1, told + "R")

    go(0, "", 0, "")
    return best


@settings(max_examples=150, deadline=None)
@given(CODES)
def test_cheapest_edits(codes):
    assert audit_paths.chosen(audit_paths.begun(audit_paths.edits_from(codes))) == cheapest(codes)


@pytest.mark.parametrize("seed", range(5))
def test_colliding_hashes_are_noticed(monkeypatch, seed):
    monkeypatch.setattr(audit_paths, "_PRIME", 5)
    rng = random.Random(seed)
    for _ in range(40):
        codes = "".join(rng.choices("xsuaoSUAO", k=rng.randint(0, 5)))
        assert audit_paths.chosen(audit_paths.begun(audit_paths.edits_from(codes))) == cheapest(codes)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("xsuaoSUAO"), max_size=60), st.lists(st.integers(1, 9), min_size=60, max_size=60))
def test_stretches_put_together(codes, lengths):
    whole = audit_paths.chosen(audit_paths.begun(audit_paths.edits_from(codes)))
    ways, left = audit_paths.start(), codes
    for length in lengths:
        part, left = left[:length], left[length:]
        if part:
            ways = audit_paths.followed_by(ways, {state: audit_paths.edits_from(part, state) for state in audit_paths.STATES})
    assert audit_paths.chosen(ways) == whole


@given(st.lists(st.text("DIKR", max_size=30), min_size=2, max_size=6))
def test_order_of_linked_strings(texts):
    prefixes = audit_paths.Prefixes()
    nodes = []
    for text in texts:
        node = 0
        for letter in text:
            node = prefixes.add(node, letter)
        nodes.append(node)
        assert prefixes.text(node) == text and prefixes.ancestor(node, 0) == 0
    for a, left in zip(nodes, texts):
        for b, right in zip(nodes, texts):
            assert prefixes.less(a, b) == (left < right)


def plain(rows):
    """Report by conversation of rows (conv, turn, role, text), damaged here."""
    convs = {}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        said = convs.setdefault(conv, [])
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        said += [(turn is not None, turn or 0, role, sha256(text.encode()).digest(), text)] * (2 if fault == 3 else 1)
    for conv, said in convs.items():
        said.sort()
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, _, text in said:
            left = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None
            seen.add((role, text))
            if kind:
                faults[kind] += 1
            code = role[:1] if role[:1] in ("s", "u", "a") else "o"
            codes += "x" if kind in ("blank", "duplicate") else code.upper() if kind else code
        turns = {turn for known, turn, *_ in said if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = cheapest(codes)
        out, at = [], 0
        system = False
        for letter in audit:
            following = "user" if (len(out) - system) % 2 == 0 else "assistant"
            if letter == "I":
                out.append(f"{following}:")
                continue
            _, _, role, _, text = said[at]
            at += 1
            if letter == "D":
                continue
            system = system or not out and letter == "K" and role[:1] == "s"
            out.append(f"{following if letter == 'R' else role}:{text}")
        yield conv, gaps, *faults.values(), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest()


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def made(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Hello there.", "What?", "no end", "", " \n", None, "Ünd?\t ", "dot. no", "x" * 3000 + "!", "ok."]
    rows = []
    for conv in convs:
        for turn in range(rng.randint(0, longest)):
            role = rng.choices(["user", "assistant", "system", "tool", None, "sys", ""], [8, 8, 2, 1, 1, 1, 1])[0]
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, rng.choice(texts)))
    return rows


@pytest.mark.parametrize("stretch", [2, 3, 16_384])
def test_report_against_plain_rules(spark, monkeypatch, stretch):
    monkeypatch.setattr(conversation_repair, "STRETCH", stretch)
    rows = made(stretch, [*range(60), None], 5)
    rows += rows[:4]
    frame = spark.createDataFrame([(*row, 1, "c") for row in rows], "conv_id long, turn long, role string, text string, copies int, audit string").repartition(5)
    monkeypatch.setattr(queries, "_table", lambda *_: frame)
    got = queries.op13_conversation_repair(spark, "")
    want = sorted(plain(rows), key=str)
    assert sorted((tuple(row[name] for name in NAMES) for row in got.collect()), key=str) == want
    said = conversation_repair.messages(queries.damaged(frame), copies=queries.F.col("copies"))
    left = conversation_repair.repaired_messages(said, conversation_repair.audits(said)).collect()
    texts = {}
    for row in sorted(left, key=lambda row: row.place):
        assert row.place == len(texts.setdefault(row.conv, []))
        texts[row.conv].append(f"{row.role}:{row.text}")
    digests = {row[0]: row[-1] for row in want}
    assert all(sha256("\n".join(found).encode()).hexdigest() == digests[conv] for conv, found in texts.items())


def test_given_table(spark):
    path = queries.__dict__["_table"](spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(row) for row in path.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, "/root/testdata/sf0.001")
    short = {conv for conv in {row[0] for row in rows} if sum(row[0] == conv for row in rows) <= 7}
    want = sorted(plain([row for row in rows if row[0] in short]), key=str)
    assert sorted((tuple(row[name] for name in NAMES) for row in got.collect() if row.conv_id in short), key=str) == want


def test_one_long_conversation(spark, monkeypatch):
    """Cut over tasks and stretches, it is repaired as in one piece."""
    rng = random.Random(1)
    rows = [(7, turn, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{turn}.", f"t{turn}", "again.", ""])) for turn in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    said = conversation_repair.messages(frame)
    monkeypatch.setattr(conversation_repair, "STRETCH", 100)
    (row,) = conversation_repair.audits(said).collect()
    seen, codes = set(), ""
    for _, _, role, text in rows:
        gone = not text or (role, text) in seen
        seen.add((role, text))
        codes += "x" if gone else role[0] if text.endswith(".") else role[0].upper()
    assert (row.cost, row.audit) == audit_paths.chosen(audit_paths.begun(audit_paths.edits_from(codes)))
    assert row.gaps == 0 and row.blank == sum(not text for *_, text in rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair_report(frame, conversation_repair.messages(frame)).collect() == []
