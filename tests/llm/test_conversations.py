"""Conversation repair against all edits of short conversations and a plain forward search."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from pairpulse.llm import conversations

SMALL = "/root/testdata/sf0.001"
FIELDS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
COLUMNS = "conv_id long, turn long, role string, text string"
SHAPE = re.compile("(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not said else "duplicate" if (role, text) in seen
                   else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """``cost, audit, lines`` by searching forward, with the whole string as the tie-break."""
    state = {"": (0, "", ())}  # by the last role said: cost, edits, lines; "s" only at the start

    def offer(into, last, role, value):
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if role[:1] and role[:1] in follows and (role[:1] not in into or value[:2] < into[role[:1]][:2]):
            into[role[:1]] = value

    def inserted(state):
        for _ in range(3):
            grown = dict(state)
            for last, (cost, edits, lines) in state.items():
                for role in ("user", "assistant"):
                    offer(grown, last, role, (cost + 2, edits + "I", lines + (f"{role}:",)))
            state = grown
        return state

    for (_, _, role, text), fault in zip(rows, found):
        into = {}
        for last, (cost, edits, lines) in inserted(state).items():
            value = (cost + 3, edits + "D", lines)
            if last not in into or value[:2] < into[last][:2]:
                into[last] = value
            if fault not in ("blank", "duplicate"):
                stays = fault == "truncated"
                offer(into, last, role, (cost + stays, edits + "K", lines + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    offer(into, last, new, (cost + 2 + stays, edits + "R", lines + (f"{new}:{text}",)))
        state = into
    return min(v for k, v in inserted(state).items() if k in ("", "a"))


def expected(rows):
    """The contract's row for one conversation, of rows after damage in order."""
    found = faults(rows)
    cost, audit, lines = cheapest(rows, found)
    turns = [r[1] for r in rows if r[1] is not None]
    legal = {"su", "ua", "au"}
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"),
            found.count("duplicate"), found.count("truncated"),
            sum(a[2][:1] + b[2][:1] not in legal for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(found, rows, order=lambda r: (r[1] is not None, r[1] or 0, r[2])):
    own = {}
    for r in damage(rows):
        own.setdefault(r[0], []).append(r)
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    assert got == {c: expected(sorted(own.get(c, []), key=order)) for c in {r[0] for r in rows}}


def test_forward_search_finds_the_least_of_all_edits():
    """Every string of edits of up to three rows, against the search used below."""
    texts = {"k": "Fine.", "t": "cut", "b": " "}
    for size in (0, 1, 2, 3):
        for kinds in itertools.product(["user.k", "assistant.k", "system.t", "other.k", "user.b"], repeat=size):
            rows = [(1, i, k.split(".")[0], texts[k[-1]] + (str(i) + "." if k[-1] == "k" else "")) for i, k in enumerate(kinds)]
            found, best = faults(rows), None
            for inserts in itertools.product(range(3), repeat=size + 1):
                for edits in itertools.product("DKR", repeat=size):
                    audit = "".join("I" * n + e for n, e in zip(inserts, edits + ("",)))
                    if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, found)):
                        continue
                    free = []
                    for n, e, row in zip(inserts, edits + ("",), rows + [None]):
                        free += [None] * n + ([] if e in ("D", "") else [row[2][0] if e == "K" else None])
                    if any(SHAPE.fullmatch("".join(x)) for x in itertools.product(
                            *([c] if c else "ua" for c in free))):
                        cost = 2 * sum(inserts) + sum(
                            {"D": 3, "K": 0, "R": 2}[e] + (f == "truncated" and e != "D") for e, f in zip(edits, found))
                        best = min(best or (cost, audit), (cost, audit))
            assert cheapest(rows, found)[:2] == best


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op13_conversation_repair"](spark, SMALL)
    assert tuple(got.columns) == FIELDS
    assert [got.schema[c].dataType.simpleString() for c in FIELDS[:-2]] == ["bigint"] * 7
    check(got, rows)


def test_query_equals_sql(spark):
    name = "op13_conversation_repair"
    assert differences(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) is None


def made_up(n, convs, seed):
    chosen = random.Random(seed)
    texts = ["Fine.", "cut off", "", " \t", None, "So?", "x!\n", "a.b", " ", "Hm…"]
    rows = []
    for c in range(convs):
        for t in range(chosen.randint(0, n) if c else n):
            text = chosen.choice(texts)
            unique = f"{t} {text}" if text and chosen.random() < 0.8 else text
            rows.append((c if c < convs - 1 else None, t + (t > 2) * 3,
                         chosen.choice(["user", "assistant", "system", "tool", "", None, "User"]), unique))
    return rows


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_made_up_conversations_in_blocks_of_any_size(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = made_up(12, 60, bits)
    check(conversations.repair_digests(spark.createDataFrame(rows, COLUMNS).repartition(5)), rows)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_BITS", 4)
    rows = made_up(3000, 3, 7)
    frame = spark.createDataFrame(rows, COLUMNS)
    check(conversations.repair_digests(frame), rows)
    sizes = [len(r.codes) for r in conversations._blocks(conversations._in_order(conversations._rows(frame))).collect()]
    assert max(sizes) <= 64 < len(sizes)  # the square root of 3000, as a power of two


def test_equal_rows_and_turns_without_a_number(spark):
    rows = [(1, None, "user", "Same.")] * 400 + [(1, 5, "assistant", "Yes.")] + [(2, 3, "user", "Same.")] * 3
    check(conversations.repair_digests(spark.createDataFrame(rows, COLUMNS)), rows)


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."),
            (1, 9, "user", "Who?")]
    verdict, after = conversations.repaired(spark.createDataFrame(
        [r + ("x", 3) for r in rows], COLUMNS + ", block string, at long"))
    one = verdict.first()
    assert (one.gaps, one.duplicate, one.illegal, one.cost, one.audit) == (6, 1, 3, 7, "KIKKDR")
    got = [(r.edit, r.turn, r.role, r.text) for r in after.orderBy("block", "at").collect()]
    assert SHAPE.fullmatch("".join(r[2][0] for r in got)) and got[0] == ("K", 0, "system", "Be kind.")
    assert "".join(r[0] for r in got) == one.audit.replace("D", "")
    assert all((r[0] == "I") == (r[1] is None and r[3] == "") for r in got)


def test_no_conversations(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert conversations.repair_digests(none).count() == 0
    dropped = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = conversations.repair_digests(spark.createDataFrame(dropped, COLUMNS)).collect()
    assert len(got) == len(dropped) > 0
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_extreme_turns(spark):
    rows = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "Yes.")]
    verdict, _ = conversations.repaired(spark.createDataFrame(rows, COLUMNS))
    assert verdict.first().gaps is None and Counter(verdict.first().audit) == {"K": 2}
