"""Repairs against a search over all edits, row by row."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from tokenloom.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n string, chunk int"
BLANK = re.compile(r"[\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Rows of each conversation after damage, in order."""
    out = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out[conv] += [(turn, role, text)] * (2 if code == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[2].encode()).hexdigest(), r[1]))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = BLANK.sub("", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, lines) by a search that carries the roles given so far, cut where no ending is left."""
    initials = [r[1][:1] for r in rows]

    @functools.cache
    def best(i, state):
        # state: "" nothing yet, else the last initial given
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        ask = "a" if state == "u" else "u"
        role = "user" if ask == "u" else "assistant"
        moves = []
        if i < len(rows):
            moves.append((4, "D", (), i + 1, state))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                _, own, text = rows[i]
                if initials[i] == ask or (initials[i] == "s" and state == ""):
                    moves.append((more, "K", (f"{own}:{text}",), i + 1, initials[i]))
                moves.append((3 + more, "R", (f"{role}:{text}",), i + 1, ask))
        for cost, letter, lines, j, to in moves:
            c, a, rest = best(j, to)
            options.append((cost + c, letter + a, lines + rest))
        # Up to two insertions here, then a move or the end.
        for count in (1, 2):
            at, given = state, ()
            for _ in range(count):
                at = "a" if at == "u" else "u"
                given += ("user:" if at == "u" else "assistant:",)
            if i == len(rows):
                if at == "a":
                    options.append((3 * count, "I" * count, given))
                continue
            ask2 = "a" if at == "u" else "u"
            options2 = [(4, "D", (), i + 1, at)]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                _, own, text = rows[i]
                if initials[i] == ask2:
                    options2.append((more, "K", (f"{own}:{text}",), i + 1, ask2))
                options2.append((3 + more, "R", (f"{'user' if ask2 == 'u' else 'assistant'}:{text}",), i + 1, ask2))
            for cost, letter, lines, j, to in options2:
                c, a, rest = best(j, to)
                options.append((3 * count + cost + c, "I" * count + letter + a, given + lines + rest))
        return min(options)

    return best(0, "")


def exhaustive(rows, faults):
    """(cost, audit) by trying every list of edits with at most two insertions in a gap; for a few rows."""
    best = (10**9, "")
    choices = [[("D", None)] + ([] if fault in ("blank", "duplicate") else [("K", role[:1]), ("R", "u"), ("R", "a")]) for (_, role, _), fault in zip(rows, faults)]
    gaps = ["", "u", "a", "ua", "au"]
    for picked in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            given, audit, cost = inserted[0], "I" * len(inserted[0]), 3 * len(inserted[0])
            for (letter, initial), extra, fault in zip(picked, inserted[1:], faults):
                given += (initial or "") + extra
                audit += letter + "I" * len(extra)
                cost += {"D": 4, "K": 0, "R": 3}[letter] + 3 * len(extra) + (3 if fault == "truncated" and letter != "D" else 0)
            if GRAMMAR.fullmatch(given):
                best = min(best, (cost, audit))
    return best


def expected(rows):
    out = []
    for conv, held in damaged(rows).items():
        faults = faults_of(held)
        cost, audit, lines = cheapest(held, faults)
        turns = {t for t, *_ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = zip([r[1][:1] for r in held], [r[1][:1] for r in held][1:])
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((str(conv), gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest))
    return sorted(out)


def got(frame, **more):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((str(r.conv_id), *(r[name] for name in names)) for r in cr.repair_conversations(frame, **more).collect())


def corpus(seed, conversations=40):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        roles = ["system"] * draw.randrange(2) + ["user", "assistant"] * draw.randrange(4)
        for turn, role in enumerate(roles):
            if draw.random() < 0.25:
                role = draw.choice(["user", "assistant", "system", "tool", "", None])
            text = draw.choice(["Hello there.", "What?", "no end", "Fine!", " \n", "", None, f"text {draw.randrange(99)}.", "a\nb."])
            rows.append((conv, draw.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs_against_search(spark, seed):
    rows = corpus(seed)
    rows += [(None, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(9)]
    rows += [(1, 0, "user", "same.")] * 6 + [(900, 3, "user", "long text. " * 40_000), (901, None, None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    assert got(frame) == expected(rows)


def test_a_conversation_of_many_chunks(spark):
    """One conversation with most rows, over many blocks, with a crowded turn and rows without turn."""
    draw = random.Random(5)
    rows = [(7, t, draw.choice(["user", "assistant", "assistant", "system"]), draw.choice([f"row {t}.", f"row {t % 50}.", f"cut {t}", ""])) for t in range(700)]
    rows += [(7, 40, "user", f"crowd {i}.") for i in range(150)] + [(7, None, "assistant", f"none {i}.") for i in range(60)] + [(8, 1, "user", "b.")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(frame, block=16, crowded=40) == expected(rows)
    pieces = cr.chunks_of(cr.with_faults(cr.damage(frame)), 16, 40).collect()
    assert len(pieces) > 60 and max(len(r.rows) for r in pieces) <= 40


def test_automaton_against_every_edit():
    """Costs and audits of short conversations against all lists of edits."""
    draw = random.Random(9)
    for _ in range(60):
        rows = [(i, draw.choice(["system", "user", "assistant", "tool"]), f"{i}") for i in range(draw.randrange(4))]
        faults = [draw.choice(["", "", "blank", "duplicate", "truncated"]) for _ in rows]
        automaton, node = cr.Automaton(), 0
        for (_, role, _), fault in reversed(list(zip(rows, faults))):
            place = "sua".find(role[0]) % 4 if role[0] in "sua" else 3
            node = automaton.add(cr.LETTERS[place * 4 + cr.FAULTS.index(fault or "none")], node)
        assert (automaton.cost[node][cr.START], automaton.audit(node)) == exhaustive(rows, faults) == cheapest(rows, faults)[:2]


def test_suffixes_are_shared():
    """Sorted by their ends, three signatures with a common suffix need its nodes once."""
    made = []

    class Counted(cr.Automaton):
        def add(self, letter, rest):
            made.append(letter)
            return super().add(letter, rest)

    import pyarrow as pa

    plain, cr.Automaton = cr.Automaton, Counted
    try:
        signatures = sorted(["EIEI", "AEIEI", "IEIEI", "EI", ""], key=lambda s: s[::-1])
        batch = pa.RecordBatch.from_arrays([pa.array(signatures)], names=["signature"])
        rows = [r for b in cr._plan(iter([batch])) for r in b.to_pylist()]
    finally:
        cr.Automaton = plain
    assert len(made) == 6
    assert {r["signature"]: (r["cost"], r["audit"]) for r in rows} == {"": (0, ""), "EI": (0, "KK"), "EIEI": (0, "KKKK"), "AEIEI": (0, "KKKKK"), "IEIEI": (3, "IKKKKK")}


def test_empty_table(spark):
    assert cr.repair_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_against_search(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    found = cr.op13(spark, folder)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((str(r.conv_id), *(r[n] for n in names[1:])) for r in found.collect()) == expected(rows)
