"""Conversation structure repair: the cheapest edits that give each conversation a regular order of roles.

Conversations are repartitioned by id and sorted by turn inside the partitions, so each streams through one task in
order, however many Arrow batches it takes. A search over four states (nothing yet, after a system row, after a user row,
after an assistant row) goes forward with it. Costs are kept relative to the least one, and a state that lies further
behind than any state can catch up is dead, so that only a small number of situations exists: each step is looked up in a table
that fills itself. A row leaves behind four bytes, for each state the way that led there. Rows and these bytes of a giant
conversation go to files in the shared scratch folder in blocks; at its end the bytes are read backwards, block by
block, and then the rows forwards. Which rows repeat earlier ones is found by sorting the same partitions by text
beforehand, so no set of texts is held either.

The repaired roles read, by their initials, ``(s?(ua)+)?``. Edits: K keeps a row, R gives it the role user or assistant,
D deletes it, I inserts a row without text. Of equally cheap edits the least in ASCII order counts; as each letter leads
from a state to one other state only, the edits also tell all roles.

Defined results: a null role or text is one space; a null conversation id is an id of its own; null turns come first;
rows of one turn are ordered by role and text, repeated rows stand side by side. A conversation without rows has zeros,
no edits and the hash of the empty text. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import files
from kerbside.llm.common import SPACE, ready
from kerbside.session import scratch_dir

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)  # where the only regular user or assistant row leads to
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
CLOSING = (0, 2, 1, 0)  # rows to insert at the end
LEGAL = frozenset(("su", "ua", "au"))
LETTERS = "DKR"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

HELD_ROWS = 100_000  # of one conversation in memory
HELD_CHARS = 16_000_000


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # of a truncated row that stays

    @property
    def margin(self) -> int:
        """No state can catch up more: two rows inserted and one deleted lead from each state to what another can do."""
        return 2 * self.insert + self.delete


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage that depends on ``conv_id:turn``; a dropped row stays as a row that is not ``present``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    harm = F.crc32(key.cast("binary")) % 20
    marked = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), harm.alias("harm"))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit(""))
        .when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("harm") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def in_order(turns: DataFrame) -> DataFrame:
    """Each conversation in one partition, by turn, with the fault of every row.

    One exchange: the window over equal rows and the order of turns both sort the partitions of the first one.
    """
    shaped = turns.select(
        "conv_id",
        "turn",
        "present",
        F.when(F.col("present"), F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(F.col("present"), F.coalesce(F.col("text").cast("string"), F.lit(" "))).alias("text"),
    )
    equal = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.asc_nulls_first("turn"))
    numbered = shaped.repartition("conv_id").withColumn("nth", F.row_number().over(equal))
    content: Column = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(content == "", F.lit(BLANK))
        .when(F.col("nth") > 1, F.lit(DUPLICATE))
        .when(~F.right(content, F.lit(1)).isin(".", "!", "?"), F.lit(TRUNCATED))
        .otherwise(F.lit(NONE))
    )
    rows = numbered.withColumn("fault", F.when(F.col("present"), fault).otherwise(F.lit(-1)))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    # Ids and turns as text: exact in pandas, nulls included.
    return rows.sortWithinPartitions(*order, "nth").select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role", "text", "fault"
    )


class Steps:
    """Forward steps of the search, each worked out once.

    A situation holds for each state the cost above the least one and the place of the edits so far in ASCII order
    among those of the other states, or nothing where the state is out of reach. Edits end with the letter of
    the last row, so none is the beginning of another and the order of two never changes later.
    """

    def __init__(self, costs: Costs):
        self.costs = costs
        self.situations: list[tuple] = []
        self.places: dict[tuple, int] = {}
        self.known: dict[tuple[int, str, int], tuple[int, int, bytes]] = {}
        self.start = self._place(((0, 0), None, None, None))

    def _place(self, situation: tuple) -> int:
        if situation not in self.places:
            self.places[situation] = len(self.situations)
            self.situations.append(situation)
        return self.places[situation]

    def step(self, at: int, initial: str, fault: int) -> tuple[int, int, bytes]:
        """The next situation, what the least cost rises by, and for each state the way to it."""
        key = at, initial, fault
        if key not in self.known:
            self.known[key] = self._step(self.situations[at], initial, fault)
        return self.known[key]

    def _step(self, situation: tuple, initial: str, fault: int) -> tuple[int, int, bytes]:
        costs, ways = self.costs, [None] * 4
        stay = costs.truncated if fault == TRUNCATED else 0
        for origin, entry in enumerate(situation):
            if entry is None:
                continue
            state = origin
            for inserted in range(3):
                cost, before = entry[0] + inserted * costs.insert, "I" * inserted
                moves = [("D", state, costs.delete)]
                if fault in (NONE, TRUNCATED):
                    moves.append(("R", NEXT[state], costs.rerole + stay))
                    if initial in KEEP[state]:
                        moves.append(("K", KEEP[state][initial], stay))
                for letter, target, more in moves:
                    code = origin | inserted << 2 | LETTERS.index(letter) << 4
                    way = (cost + more, entry[1], before + letter, code)
                    if ways[target] is None or way < ways[target]:
                        ways[target] = way
                state = NEXT[state]
        least = min(way[0] for way in ways if way)
        alive = [way if way and way[0] - least <= costs.margin else None for way in ways]
        order = sorted((way[1:3], state) for state, way in enumerate(alive) if way)
        ranks = {state: rank for rank, (_, state) in enumerate(order)}
        after = tuple(way and (way[0] - least, ranks[state]) for state, way in enumerate(alive))
        return self._place(after), least, bytes(way[3] if way else 0 for way in alive)

    def end(self, at: int) -> tuple[int, int]:
        """The best last state, and the cost above the least one with the rows inserted at the end."""
        ends = [
            (entry[0] + CLOSING[state] * self.costs.insert, entry[1], state)
            for state, entry in enumerate(self.situations[at])
            if entry
        ]
        cost, _, state = min(ends)
        return state, cost


class Reading:
    """One conversation while its rows come in."""

    def __init__(self, key: str | None, steps: Steps, folder: str, held_rows: int, held_chars: int):
        self.key, self.steps, self.folder = key, steps, folder
        self.most = held_rows, held_chars
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.codes = bytearray()
        self.chars = 0
        self.blocks: list[tuple[str, str]] = []  # files of rows and of ways
        self.at, self.cost = steps.start, 0
        self.faults = [0, 0, 0, 0]
        self.illegal, self.last = 0, None
        self.turns, self.first_turn, self.last_turn = 0, None, None

    def add(self, turn: str | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.last_turn:  # by turn, so equal ones meet
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        self.at, more, code = self.steps.step(self.at, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += more
        self.codes += code
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(role) + len(text)
        if len(self.roles) >= self.most[0] or self.chars >= self.most[1]:
            self._spill()

    def _spill(self) -> None:
        rows = pa.record_batch([pa.array(self.roles, pa.string()), pa.array(self.texts, pa.string())], names=["role", "text"])
        with files.new_file(self.folder, ".rows") as (rows_path, stream), pa.ipc.new_stream(stream, rows.schema) as writer:
            writer.write_batch(rows)
        with files.new_file(self.folder, ".ways") as (ways_path, stream):
            stream.write(bytes(self.codes))
        self.blocks.append((rows_path, ways_path))
        self.roles, self.texts, self.codes, self.chars = [], [], bytearray(), 0

    def gaps(self) -> int:
        return int(self.last_turn) - int(self.first_turn) + 1 - self.turns if self.turns else 0

    def finish(self) -> None:
        """Goes back over the ways: one code a row, in order, and the state at the end."""
        state, more = self.steps.end(self.at)
        self.cost += more
        self.closing = CLOSING[state]
        chosen: list[bytearray] = []
        for block in [None, *reversed(self.blocks)]:
            codes = self.codes if block is None else _read(block[1])
            own = bytearray(len(codes) // 4)
            for nth in range(len(own) - 1, -1, -1):
                own[nth] = code = codes[4 * nth + state]
                state = code & 3
            chosen.append(own)
        self.chosen = chosen[::-1]

    def audit(self) -> str:
        rows = "".join("I" * (code >> 2 & 3) + LETTERS[code >> 4] for own in self.chosen for code in own)
        return rows + "I" * self.closing

    def repaired(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every row of the repaired conversation; files are gone afterwards."""
        state = START
        for own, block in zip(self.chosen, [*self.blocks, None], strict=True):
            if block is None:
                rows = zip(self.roles, self.texts, strict=True)
            else:
                held = pa.ipc.open_stream(_read(block[0])).read_all()
                rows = zip(held["role"].to_pylist(), held["text"].to_pylist(), strict=True)
            for code, (role, text) in zip(own, rows, strict=True):
                for _ in range(code >> 2 & 3):
                    state = NEXT[state]
                    yield "I", ROLES[state], ""
                letter = LETTERS[code >> 4]
                if letter == "K":
                    state = KEEP[state][role[:1]]
                    yield letter, role, text
                elif letter == "R":
                    state = NEXT[state]
                    yield letter, ROLES[state], text
        for _ in range(self.closing):
            state = NEXT[state]
            yield "I", ROLES[state], ""
        for block in self.blocks:
            for path in block:
                store, name = files.locate(path)
                store.delete_file(name)
        self.blocks, self.chosen = [], self.chosen[-1:]


def _read(path: str) -> bytes:
    with files.open_file(path) as stream:
        return stream.read()


def _conversations(
    batches: Iterator[pd.DataFrame], costs: Costs, folder: str, held_rows: int, held_chars: int
) -> Iterator[Reading]:
    """The conversations of a partition, each when its last row has been read, whatever batches its rows came in."""
    steps, reading = Steps(costs), None
    for batch in batches:
        columns = (batch[name].tolist() for name in ("conv_id", "turn", "role", "text", "fault"))
        for key, turn, role, text, fault in zip(*columns, strict=True):
            if reading is None or key != reading.key:
                if reading is not None:
                    reading.finish()
                    yield reading
                reading = Reading(key, steps, folder, held_rows, held_chars)
            if fault >= 0:
                reading.add(turn, role, text, fault)
    if reading is not None:
        reading.finish()
        yield reading


def _with_presence(turns: DataFrame) -> DataFrame:
    return turns if "present" in turns.columns else turns.withColumn("present", F.lit(True))


def _bunched(rows: Iterator[tuple], names: list[str], most: int = 2000, chars: int = 8_000_000) -> Iterator[pd.DataFrame]:
    bunch, size = [], 0
    for row in rows:
        bunch.append(row)
        size += sum(len(value) for value in row if isinstance(value, str))
        if len(bunch) >= most or size >= chars:
            yield pd.DataFrame(bunch, columns=names)
            bunch, size = [], 0
    if bunch:
        yield pd.DataFrame(bunch, columns=names)


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair_report(
    turns: DataFrame, costs: Costs = Costs(), held_rows: int = HELD_ROWS, held_chars: int = HELD_CHARS
) -> DataFrame:
    """For every conversation of ``turns`` (conv_id, turn, role, text; optionally ``present``): gaps in its turns, rows by
    first fault, illegal neighbours, the cost of the cheapest repair, its letters and the SHA-256 of what it gives."""
    ready(turns.sparkSession)
    folder = scratch_dir(turns.sparkSession, "conversations")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for found in _conversations(batches, costs, folder, held_rows, held_chars):
                audit, digest = found.audit(), hashlib.sha256()
                for nth, (_, role, text) in enumerate(found.repaired()):
                    digest.update(f"{chr(10) if nth else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                counts = (found.gaps(), *found.faults[BLANK:], found.illegal, found.cost)
                yield (found.key, *counts, audit, digest.hexdigest())

        yield from _bunched(rows(), ["conv_id", *REPORT, "audit", "repaired_sha256"])

    schema = f"conv_id string, {', '.join(f'{c} bigint' for c in REPORT)}, audit string, repaired_sha256 string"
    found = in_order(_with_presence(turns)).mapInPandas(run, schema)
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def repaired_turns(
    turns: DataFrame, costs: Costs = Costs(), held_rows: int = HELD_ROWS, held_chars: int = HELD_CHARS
) -> DataFrame:
    """The repaired conversations themselves: conv_id, turn (0, 1, ...), role, text and the edit that made the row."""
    ready(turns.sparkSession)
    folder = scratch_dir(turns.sparkSession, "conversations")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for found in _conversations(batches, costs, folder, held_rows, held_chars):
                for nth, (edit, role, text) in enumerate(found.repaired()):
                    yield found.key, nth, role, text, edit

        yield from _bunched(rows(), ["conv_id", "turn", "role", "text", "edit"])

    schema = "conv_id string, turn bigint, role string, text string, edit string"
    found = in_order(_with_presence(turns)).mapInPandas(run, schema)
    return found.withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))
