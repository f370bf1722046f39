"""Conversation repair against exhaustive search, across segment ends, and through Spark."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from conftest import SF_MID, SF_SMALL
from tables import awkward, write

from shopsignal.llm import conversation_repair as cr
from shopsignal.llm.queries import QUERIES

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?\Z")
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", " ", "unknown", ""]
TEXTS = ["Hi.", "Yes", "No!", "", " \n", "Hi.", "w?", "a \t", "é\x0c"]


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        visible = VISIBLE.findall(text)
        found.append("blank" if not visible else "duplicate" if (role, text) in seen
                     else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def exhaustive(rows):
    """(cost, audit, repaired text) of the best of all edit lists with at most two inserts in a row."""
    speakers = ("user", "assistant")
    inserts = [[("I", x, "", 3) for x in xs] for k in range(3) for xs in itertools.product(speakers, repeat=k)]
    choices = []
    for (role, text), fault in zip(rows, faults(rows)):
        own = [("D", None, None, 4)]
        if fault not in ("blank", "duplicate"):
            extra = 3 * (fault == "truncated")
            own += [("K", role, text, extra)] + [("R", x, text, 3 + extra) for x in speakers]
        choices.append([[*i, e] for i in inserts for e in own])
    best = None
    for combination in itertools.product(*choices, inserts):
        edits = [e for part in combination for e in part]
        cost = sum(e[3] for e in edits)
        if best and cost > best[0]:
            continue
        said = [(e[1], e[2]) for e in edits if e[0] != "D"]
        if GOOD.match("".join(r[:1] or "?" for r, _ in said)):
            found = (cost, "".join(e[0] for e in edits), "\n".join(f"{r}:{t}" for r, t in said))
            best = min(best or found, found)
    return best


def states(rows):
    """A plain dynamic program over (cost, audit, text) tuples: no weights, no segments."""
    best = {"": (0, "", ())}

    def spoken(state, initial):
        return state + initial if GOOD.match(state + initial + "a" * (initial == "u") + "ua" * (initial == "s")) else None

    def fold(state):
        return state if len(state) < 4 else state[:-2]

    def offer(table, state, value):
        if state is not None:
            state = fold(state)
            table[state] = min(table.get(state, value), value)

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit, said) in list(table.items()):
                who = "assistant" if state.endswith("u") else "user"
                offer(table, spoken(state, who[0]), (cost + 3, audit + "I", (*said, f"{who}:")))

    for (role, text), fault in zip(rows, faults(rows)):
        inserted(best)
        behind = {}
        for state, (cost, audit, said) in best.items():
            offer(behind, state, (cost + 4, audit + "D", said))
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    offer(behind, spoken(state, role[0]), (cost + extra, audit + "K", (*said, f"{role}:{text}")))
                who = "assistant" if state.endswith("u") else "user"
                offer(behind, spoken(state, who[0]), (cost + extra + 3, audit + "R", (*said, f"{who}:{text}")))
        best = behind
    inserted(best)
    cost, audit, said = min(v for s, v in best.items() if GOOD.match(s))
    return cost, audit, "\n".join(said)


def repaired(rows):
    r = cr.Repair()
    for turn, (role, text) in enumerate(rows):
        r.add(turn, role, text)
    return r.result()


@pytest.mark.parametrize("segment", [1, 2, 64])
def test_small_conversations_against_every_edit_list(segment, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    cr.weighted.cache_clear()
    rng = random.Random(segment)
    for _ in range(60):
        rows = [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randint(0, 3))]
        cost, audit, text = exhaustive(rows)
        assert states(rows) == (cost, audit, text)
        got = repaired(rows)
        assert got[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
    cr.weighted.cache_clear()


def test_long_conversations_across_segments():
    rng = random.Random(9)
    for n in (63, 64, 65, 128, 300, 1000):
        rows = [(rng.choice(ROLES), rng.choice(TEXTS) + (str(i) + rng.choice("..x") if rng.random() < 0.8 else "")) for i in range(n)]
        cost, audit, text = states(rows)
        assert repaired(rows)[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())


def brute_query(rows):
    after = collections.defaultdict(list)
    for r in rows:
        n = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{n(r['conv_id'])}:{n(r['turn'])}".encode()) % 20
        role, text = n(r["role"]), n(r["text"])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        after[r["conv_id"]] += [(r["turn"], role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, turns in after.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        said = [t[1:] for t in turns]
        found = collections.Counter(faults(said))
        numbers = {t[0] for t in turns} - {None}
        initials = [r[:1] for r, _ in said]
        cost, audit, text = states(said)
        out.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, found["blank"], found["duplicate"],
                    found["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("folder", [SF_SMALL, SF_MID, "awkward"])
def test_query(spark, folder, tmp_path):
    if folder == "awkward":
        folder = write(tmp_path / "conversations", awkward())
        rows = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    else:
        rows = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    got = [tuple(r) for r in QUERIES["op13_conversation_repair"](spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(brute_query(rows), key=repr)


def test_dropped_conversation_and_one_that_is_hot(spark):
    dropped = next(i for i in range(10_000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "Gone.")] + [(None, t % 700, "user" if t % 3 else "assistant", f"Turn {t}.") for t in range(3000)]
    rows += [(50_000 + i, 1, "user", "Hello.") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: tuple(r) for r in cr.decide(cr.damage(df)).collect()}
    assert got[dropped] == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = brute_query([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in rows])
    assert sorted(got.values(), key=repr) == sorted(want, key=repr)


def test_repaired_rows_have_the_digest(spark):
    conversations = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    for rows in (cr.damage(conversations), cr.as_rows(conversations)):
        decisions = cr.decide(rows)
        turns = collections.defaultdict(list)
        for r in cr.repaired(rows, decisions).collect():
            turns[r["conv_id"]].append((r["place"], r["edit"], f"{r['role']}:{r['text']}"))
        for d in decisions.collect():
            said = sorted(turns[d["conv_id"]])
            assert [p for p, _, _ in said] == list(range(len(said)))
            assert "".join(e for _, e, _ in said) == d["audit"].replace("D", "")
            assert hashlib.sha256("\n".join(x for _, _, x in said).encode()).hexdigest() == d["repaired_sha256"]
