"""Operator 13, conversation structure repair: cheapest edits by an automaton with shared suffixes.

A conversation's signature has one letter a row: the class of its role initial and its first fault.
The cheapest repair of the rest of a conversation depends on that rest and on the grammar state only,
so equal suffixes of signatures, of whatever conversations, are one node of an acyclic automaton built
from the end, and a node has its cost-to-go and the first edit of its best audit once for each state.
Distinct signatures are sorted by their reversed letters and dealt in ranges, so all that share a suffix
lie side by side: the nodes on the path to the current signature are kept, and only what differs is added.

A conversation may hold a third of all rows, so it is never one group of rows. Equal rows of a turn are
one row with a number; rows are dealt to chunks of ``BLOCK`` turns (a crowded block by turn and
digest); a chunk gives its letters, gets its part of the audit and repairs its own rows. Of a whole conversation
only its letters, one byte a row, and the result's audit come together; the digest of its text is fed
chunk by chunk.

Defined results: a NULL role or text is one space; rows of one turn (or without turn) are ordered by digest
of the text, then role; NULL is a conversation id like any other; a conversation without rows after damage has zeros,
an empty audit and the digest of nothing; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import BLANKS, query
from tokenloom.session import stage
from tokenloom.sources.readers import read_table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Turns of a chunk, and rows of a block beyond which it is cut by turn and digest.
BLOCK = 256
CROWDED = 4_096

#: Letters of a signature: class of the role initial (rows) and first fault (columns).
ROLES = "sua?"
FAULTS = ("none", "blank", "duplicate", "truncated")
LETTERS = "ABCDEFGHIJKLMNOP"

#: Grammar states: nothing yet, after system, after user, after assistant; where a user turn, an assistant turn leads.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_INSERT = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
NEVER = 1 << 60


class Automaton:
    """Nodes (letter, next node) with, for each state, the cost-to-go, the first edit and the state after it."""

    def __init__(self):
        self.cost: list[tuple[int, ...]] = []
        self.edit: list[tuple[str, ...]] = []
        self.then: list[tuple[int, ...]] = []
        self.rest: list[int] = []
        self._add([(0, "", state) if state in ENDS else (NEVER, "", state) for state in range(4)], -1)

    def _add(self, best: list[tuple[int, str, int]], rest: int) -> int:
        """Settle the insertions, which stay at the node, and store it. Edits of equal cost: the least letter."""
        for _ in range(3):  # at most two turns are inserted in a row
            best = [min(own, (INSERT + best[AFTER_INSERT[state]][0], "I", AFTER_INSERT[state])) for state, own in enumerate(best)]
        for store, column in zip((self.cost, self.edit, self.then), zip(*best)):
            store.append(column)
        self.rest.append(rest)
        return len(self.rest) - 1

    def add(self, letter: str, rest: int) -> int:
        role, fault = divmod(LETTERS.index(letter), len(FAULTS))
        after, best = self.cost[rest], []
        for state in range(4):
            ways = [(DELETE + after[state], "D", state)]
            if FAULTS[fault] not in ("blank", "duplicate"):
                extra = TRUNCATED if FAULTS[fault] == "truncated" else 0
                to = kept_state(state, ROLES[role])
                if to is not None:
                    ways.append((KEEP + extra + after[to], "K", to))
                ways.append((REROLE + extra + after[AFTER_INSERT[state]], "R", AFTER_INSERT[state]))
            best.append(min(ways))
        return self._add(best, rest)

    def cut(self, size: int) -> None:
        """Forget the nodes from ``size`` on."""
        for store in (self.cost, self.edit, self.then, self.rest):
            del store[size:]

    def audit(self, node: int) -> str:
        state, edits = START, []
        while True:
            edit = self.edit[node][state]
            if not edit:
                return "".join(edits)
            edits.append(edit)
            state = self.then[node][state]
            if edit != "I":
                node = self.rest[node]


def kept_state(state: int, role: str) -> int | None:
    """Where a kept row of that role initial leads, if it may stand there."""
    if role == "s":
        return SYSTEM if state == START else None
    if role == "u":
        return USER if state != USER else None
    return ASSISTANT if role == "a" and state == USER else None


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, cost and audit of signatures that come sorted by their reversed letters."""
    automaton, last = Automaton(), ""
    for batch in batches:
        rows = []
        for signature in batch.column("signature").to_pylist():
            letters = signature[::-1]
            same = _common(last, letters)
            automaton.cut(same + 1)  # node 0 is the end, node i follows i letters
            for place in range(same, len(letters)):
                automaton.add(letters[place], place)
            last = letters
            codes = [LETTERS.index(letter) for letter in signature]
            faults = [code % len(FAULTS) for code in codes]
            roles = "".join(ROLES[code // len(FAULTS)] for code in codes)
            illegal = sum(roles[i : i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1))
            rows.append((signature, *(faults.count(f) for f in (1, 2, 3)), illegal, automaton.cost[len(letters)][START], automaton.audit(len(letters))))
        if rows:
            kinds = [pa.string(), *[pa.int64()] * 5, pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["signature", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's part of the audit, and the state it begins in."""
    for batch in batches:
        out = []
        for chunks, signature, audit in zip(*(batch.column(name).to_pylist() for name in ("chunks", "signature", "audit"))):
            state, at, row = START, 0, 0
            for k, chunk in enumerate(chunks):
                begin, first, end = state, at, row + chunk["length"]
                # The last chunk takes the insertions after its rows; others leave them to the next.
                while at < len(audit) and (row < end or k == len(chunks) - 1):
                    edit = audit[at]
                    if edit == "K":
                        state = kept_state(state, ROLES[LETTERS.index(signature[row]) // len(FAULTS)])
                    elif edit != "D":
                        state = AFTER_INSERT[state]
                    row += edit != "I"
                    at += 1
                out.append((chunk["chunk"], begin, audit[first:at]))
        chunk, begin, part = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(begin, pa.int32()), pa.array(part, pa.string())], names=["chunk", "begin", "part"])


def repaired_lines(rows: list[dict], begin: int, part: str) -> list[str]:
    """Lines ``role:text`` of a chunk after its part of the audit; ``rows`` have role, text, n and letters."""
    lines, state, place, left = [], begin, -1, 0
    for edit in part:
        if edit == "I":
            lines.append("assistant:" if state == USER else "user:")
            state = AFTER_INSERT[state]
            continue
        if not left:
            place += 1
            left = rows[place]["n"]
        left -= 1
        row = rows[place]
        if edit == "K":
            lines.append(f"{row['role']}:{row['text']}")
            state = kept_state(state, row["role"][:1])
        elif edit == "R":
            lines.append(f"{'assistant' if state == USER else 'user'}:{row['text']}")
            state = AFTER_INSERT[state]
    return lines


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for rows, begin, part in zip(*(batch.column(name).to_pylist() for name in ("rows", "begin", "part"))):
            lines = repaired_lines(rows, begin, part)
            texts.append("\n".join(lines) if lines else None)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("place"), pa.array(texts, pa.string())], names=["conv", "place", "text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation, fed chunk by chunk; the chunks come sorted."""
    current, digest, begun, lines, kind = None, None, False, False, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    for batch in batches:
        kind = batch.column("conv").type
        for conv, text in zip(batch.column("conv").to_pylist(), batch.column("text").to_pylist()):
            if not begun or conv != current:
                if begun:
                    yield row()
                current, digest, begun, lines = conv, hashlib.sha256(), True, False
            if text is not None:
                digest.update(b"\n" * lines + text.encode("utf-8"))
                lines = True
    if begun:
        yield row()


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, n) after the damage that the checksum of ``conv:turn`` deals; equal rows are one."""
    name = F.concat(*(part for column, after in ((conv, ":"), (turn, "")) for part in (F.coalesce(F.col(column).cast("string"), F.lit(" ")), F.lit(after))))
    code = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(column), F.lit(" ")) for column in (role, text))
    hurt = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(code == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(code == 1, F.lit("")).when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(code == 3, 2).otherwise(1).alias("n"), code.alias("code"),
    )
    return hurt.where("code <> 0").groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _letter(role: Column, fault: Column) -> Column:
    initial, place = F.substring(role, 1, 1), F.lit(len(ROLES) - 1)
    for i, known in enumerate(ROLES[:-1]):
        place = F.when(initial == known, i).otherwise(place)
    return F.substring(F.lit(LETTERS), (place * len(FAULTS) + fault + 1).cast("int"), F.lit(1))


def with_faults(rows: DataFrame) -> DataFrame:
    """Damaged rows with ``digest`` and ``letters``, one for each of their ``n``."""
    trimmed = F.btrim("text", F.lit(BLANKS))
    rows = rows.select(
        "*", F.sha2("text", 256).alias("digest"), (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut")
    )
    rows = stage(rows, "repair-rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    firsts = rows.where("NOT blank").groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    firsts = firsts.select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("digest").alias("digest2"), "first")
    same = F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2")) & (F.col("digest") == F.col("digest2"))
    rows = rows.join(firsts, same, "left").drop("conv2", "role2", "digest2")
    later = F.coalesce(order > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 1).when(later, 2).when(F.col("cut"), 3).otherwise(0)
    again = _letter(F.col("role"), F.when(F.col("blank"), 1).otherwise(2))
    letters = F.concat(_letter(F.col("role"), fault), F.repeat(again, (F.col("n") - 1).cast("int")))
    return rows.withColumn("letters", letters).drop("blank", "cut", "first")


def chunks_of(rows: DataFrame, block: int = BLOCK, crowded: int = CROWDED) -> DataFrame:
    """Rows (conv, place, rows, letters, chunk): bounded pieces of conversations; ``place`` orders them, ``chunk`` numbers them."""
    rows = rows.withColumn("block", F.floor(F.col("turn") / block))
    full = rows.groupBy("conv", "block").agg(F.count("*").alias("size")).where(F.col("size") > crowded)
    full = full.select(F.col("conv").alias("conv2"), F.col("block").alias("block2"), "size")
    same = F.col("conv").eqNullSafe(F.col("conv2")) & F.col("block").eqNullSafe(F.col("block2"))
    rows = rows.join(full, same, "left")
    finer = F.col("size").isNotNull()
    place = F.struct(F.col("block"), F.when(finer, F.col("turn")).alias("turn"), F.when(finer, F.substring("digest", 1, 4)).alias("part"))
    held = F.array_sort(F.collect_list(F.struct("turn", "digest", "role", "text", "n", "letters")))
    packed = rows.groupBy("conv", place.alias("place")).agg(held.alias("rows"))
    packed = packed.withColumn("letters", F.array_join("rows.letters", ""))
    # The number is written with its chunk and so stays the same.
    return stage(packed.withColumn("chunk", F.monotonically_increasing_id()), "repair-chunks")


def plans(signatures: DataFrame) -> DataFrame:
    """Rows (signature, blank, duplicate, truncated, illegal, cost, audit) of the distinct signatures."""
    distinct = signatures.select("signature").distinct().withColumn("back", F.reverse("signature")).withColumn("head", F.substring("back", 1, 64))
    ordered = distinct.repartitionByRange("head").sortWithinPartitions("head", "back").select("signature")
    schema = "signature string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    return stage(ordered.mapInArrow(_plan, schema), "repair-plans")


def repair(rows: DataFrame, original: DataFrame, block: int = BLOCK, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame]:
    """Results of damaged ``rows`` for every conversation of ``original`` (conv), and the repaired chunks (conv, place, text)."""
    kind = rows.schema["conv"].dataType.simpleString()
    chunks = chunks_of(with_faults(rows), block, crowded)
    pieces = F.array_sort(F.collect_list(F.struct("place", "chunk", "letters")))
    whole = chunks.groupBy("conv").agg(pieces.alias("pieces")).select(
        "conv", F.transform("pieces", lambda p: F.struct(p["chunk"].alias("chunk"), F.length(p["letters"]).alias("length"))).alias("chunks"),
        F.array_join("pieces.letters", "").alias("signature"),
    )
    whole = stage(whole, "repair-signatures")
    judged = whole.join(plans(whole), "signature")
    parts = judged.select("chunks", "signature", "audit").mapInArrow(_deal, "chunk bigint, begin int, part string")
    schema = f"conv {kind}, place {chunks.schema['place'].dataType.simpleString()}, text string"
    repaired = chunks.join(parts, "chunk").select("conv", "place", "rows", "begin", "part").mapInArrow(_repair, schema)
    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "text")
    digests = ordered.mapInArrow(_digest, f"conv {kind}, repaired_sha256 string")
    turns = rows.groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.countDistinct("turn").alias("turns"))
    gaps = turns.select("conv", F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).alias("gaps"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    # NULL is a conversation too: rows of all results meet in one grouping instead of joins.
    every = original.select("conv").distinct()
    for part in (gaps, judged.select("conv", *counts, "audit"), digests):
        every = every.unionByName(part, allowMissingColumns=True)
    zero = [F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias(name) for name in ("gaps", *counts)]
    nothing = hashlib.sha256(b"").hexdigest()
    result = every.groupBy("conv").agg(
        *zero, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256")
    )
    return result, repaired


def repair_conversations(conversations: DataFrame, conv: str = "conv_id", block: int = BLOCK, crowded: int = CROWDED) -> DataFrame:
    """Damage ``conversations`` (conv, turn, role, text) and give one row of results a conversation."""
    result, _ = repair(damage(conversations, conv), conversations.select(F.col(conv).alias("conv")), block, crowded)
    return result.withColumnRenamed("conv", conv)


@query("op13_conversation_repair")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cost, audit and digest of every conversation after damage and repair."""
    return repair_conversations(read_table(spark, folder, "conversations"))
