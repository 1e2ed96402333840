"""Repair of the role structure of conversations by a generalised LR parser.

The allowed sequences of roles are a grammar. Its LR(0) automaton is driven over the rows of a
conversation, and at every row all repairs are tried side by side: keep the row, give it
another role, delete it, or insert rows without text. The stacks of all these parses share their
tails (a graph-structured stack); parses that reach equal stacks are merged, and the one with the
smallest (cost, audit) goes on. An audit has one letter per edit; of equal cost, no audit that has
used up the same rows is the beginning of another, so merging never loses the least one.

The grammar is left recursive, so there are few different stacks, and what a row does to a stack
depends on its kind alone. Rows are dealt by range of (conversation, turn): a conversation that lies
inside a range is repaired there. Those that touch an end of a range, and any with more than ``SEGMENT``
rows, are repaired in segments of at most so many rows: each segment is parsed from every stack it may start with,
the segments' results are chained, and each segment then applies the edits that were chosen for it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialise

# Costs of the edits, and what an undeleted row without an end costs besides.
KEEP, REROLE, DELETE, INSERT, UNENDED = 0, 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")  # fixed value
SEGMENT = 20_000  # rows of a conversation that a task holds
ROLE_OF = {"u": "user", "a": "assistant"}  # roles that edits may give, by terminal
RANGE = 24  # bits of a segment's number inside its range
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"

Stack = tuple  # (state, stack below); the tails are shared
Best = tuple[int, str, str]  # cost, audit, and the terminal that each letter of the audit leaves


@dataclass
class Grammar:
    """LR(0) automaton of a role grammar. Upper-case symbols are productions' names."""

    rules: tuple[tuple[str, str], ...] = (("D", ""), ("D", "T"), ("D", "sT"), ("T", "ua"), ("T", "Tua"))
    start: str = "D"
    given: str = "ua"  # terminals that rerole and insert may make
    states: list[frozenset] = field(default_factory=list)
    moves: dict[tuple[int, str], int] = field(default_factory=dict)
    known: dict[tuple, dict[Stack, Best]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.states.append(self._closed({("", self.start, 0)}))
        for number, state in enumerate(self.states):  # grows while it is walked
            for symbol in sorted({body[at] for _, body, at in state if at < len(body)}):
                after = self._closed({(h, b, at + 1) for h, b, at in state if b[at : at + 1] == symbol})
                if after not in self.states:
                    self.states.append(after)
                self.moves[number, symbol] = self.states.index(after)

    def _closed(self, items: set) -> frozenset:
        while True:
            more = {
                (head, body, 0) for _, b, at in items for head, body in self.rules if b[at : at + 1] == head
            }
            if more <= items:
                return frozenset(items)
            items = items | more

    def reduced(self, stack: Stack) -> Iterator[Stack]:
        """The stacks that one reduction makes."""
        for head, body, at in self.states[stack[0]]:
            if head and at == len(body):
                below = stack
                for _ in body:
                    below = below[1]
                if (below[0], head) in self.moves:
                    yield (self.moves[below[0], head], below)

    def settled(self, heads: dict[Stack, Best]) -> dict[Stack, Best]:
        """Reductions and insertions, until no stack is reached at less."""
        heads, waiting = dict(heads), list(heads)
        while waiting:
            stack = waiting.pop()
            cost, audit, left = heads[stack]
            found = [(below, heads[stack]) for below in self.reduced(stack)]
            for terminal in self.given:
                if (stack[0], terminal) in self.moves:
                    shifted = (self.moves[stack[0], terminal], stack)
                    found.append((shifted, (cost + INSERT, audit + "I", left + terminal)))
            for reached, best in found:
                if reached not in heads or best < heads[reached]:
                    heads[reached] = best
                    waiting.append(reached)
        return heads

    def initial(self) -> dict[Stack, Best]:
        return self.settled({(0, None): (0, "", "")})

    def over_row(self, stack: Stack, kind: str) -> dict[Stack, Best]:
        """What a row of a kind (terminal, or ``.``; ``-`` must go, ``+`` has an end, ``~`` has
        none) makes of a stack, with the insertions after it."""
        if (stack, kind) not in self.known:
            own, state = kind[0], kind[1]
            heads = {stack: (DELETE, "D", "-")}
            if state != "-":
                more = UNENDED if state == "~" else 0
                edits = [(own, KEEP, "K")] + [(t, REROLE, "R") for t in self.given]
                for terminal, cost, letter in edits:
                    if (stack[0], terminal) in self.moves:
                        reached, best = (self.moves[stack[0], terminal], stack), (cost + more, letter, terminal)
                        heads[reached] = min(best, heads.get(reached, best))
            self.known[stack, kind] = self.settled(heads)
        return self.known[stack, kind]

    def parse(self, kinds: Iterable[str], heads: dict[Stack, Best]) -> dict[Stack, Best]:
        for kind in kinds:
            after: dict[Stack, Best] = {}
            for stack, (cost, audit, left) in heads.items():
                for reached, (more, letters, terminals) in self.over_row(stack, kind).items():
                    if reached in after and after[reached][0] < cost + more:
                        continue
                    best = (cost + more, audit + letters, left + terminals)
                    if reached not in after or best < after[reached]:
                        after[reached] = best
            heads = after
        return heads

    def stacks(self) -> list[Stack]:
        """All stacks that rows of any kind can lead to, the same order everywhere."""
        found = list(self.initial())
        kinds = [own + state for own in [*sorted({t for _, b in self.rules for t in b if t.islower()}), "."] for state in "-+~"]
        for stack in found:
            found += sorted({r for k in kinds for r in self.over_row(stack, k)} - set(found), key=str)
        return found

    def accepted(self, heads: dict[Stack, Best]) -> Best:
        return heads[(self.moves[0, self.start], (0, None))]


def kind_of(role: str, text: str, seen: bool) -> tuple[str, str]:
    """The row's kind for the parser, and its first fault: blank, duplicate, truncated or none."""
    own = role[:1] if role[:1] in ("s", "u", "a") else "."
    words = text.strip(SPACE)
    if not words:
        return own + "-", "blank"
    if seen:
        return own + "-", "duplicate"
    return (own + "+", "") if words[-1] in ENDS else (own + "~", "truncated")


def repaired_lines(rows: list[tuple[str, str]], audit: str, left: str) -> Iterator[str]:
    """``role:text`` of the rows after the edits."""
    at = 0
    for letter, terminal in zip(audit, left):
        if letter == "I":
            yield f"{ROLE_OF[terminal]}:"
            continue
        role, text = rows[at]
        at += 1
        if letter != "D":
            yield f"{role if letter == 'K' else ROLE_OF[terminal]}:{text}"


@dataclass
class Facts:
    """What is counted of a run of rows; runs that follow each other add up."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_initial: str | None = None
    last_initial: str | None = None

    def then(self, other: Facts) -> Facts:
        if other.first_initial is None:
            return self
        if self.first_initial is None:
            return other
        same = self.last_turn is not None and self.last_turn == other.first_turn
        return Facts(
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + ((self.last_initial + other.first_initial) not in LEGAL_PAIRS),
            self.turns + other.turns - same,
            other.first_turn if self.first_turn is None else self.first_turn,
            self.last_turn if other.last_turn is None else other.last_turn,
            self.first_initial,
            other.last_initial,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def examined(rows: Iterable[tuple], later: Iterable[bool] | None = None) -> tuple[list[str], Facts]:
    """Kinds of the rows (turn, role, text) of a run in order, and what is counted of them."""
    kinds, facts, seen = [], Facts(), set()
    later = iter(later) if later is not None else None
    for turn, role, text in rows:
        known = next(later) if later is not None else (role, text) in seen
        seen.add((role, text))
        kind, fault = kind_of(role, text, known)
        kinds.append(kind)
        one = Facts(turns=int(turn is not None), first_turn=turn, last_turn=turn)
        one.first_initial = one.last_initial = role[:1]
        if fault:
            setattr(one, fault, 1)
        facts = facts.then(one)
    return kinds, facts


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FOUND_NAMES = [part.split()[0] for part in FOUND.split(", ")]


def _found(facts: Facts, best: Best, digest: str) -> tuple:
    counts = (facts.gaps, facts.blank, facts.duplicate, facts.truncated, facts.illegal)
    return (*counts, best[0], best[1], digest)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys, (key, rows); one run is held at a time."""
    held, key = [], None
    for batch in batches:
        places = [batch.schema.names.index(k) for k in keys]
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            own = tuple(row[p] for p in places)
            if held and own != key:
                yield key, held
                held = []
            key = own
            held.append(row)
    if held:
        yield key, held


def ordered(rows: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str) -> DataFrame:
    """conv, turn, role, text: nulls in role and text are one space."""
    return rows.select(
        F.col(id_column).alias("conv"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit(" ")).alias("text"),
    )


def _inside_ranges(rows: DataFrame, kind: str) -> DataFrame:
    """Results of the conversations that lie inside a range, and the rows of all others.

    ``part`` is the segment of such a row and ``number`` its place in its range: ranges follow each other
    in the order of the rows, and so do the segments of a range.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    schema = f"conv {kind}, {FOUND}, part long, number long, turn long, role string, text string"
    fields, size = _arrow(schema), SEGMENT

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar()
        out: list[tuple] = []
        run: list[tuple] = []
        key, started, cut, number = None, False, True, 0

        def set_apart(rows: list[tuple]) -> None:
            nonlocal number
            for conv, turn, role, text, place in rows:
                part = (place << RANGE) + number // size
                out.append((conv, *[None] * len(FOUND_NAMES), part, number, turn, role, text))
                number += 1

        def repair_run() -> None:
            kinds, facts = examined(row[1:4] for row in run)
            best = grammar.accepted(grammar.parse(kinds, grammar.initial()))
            lines = "\n".join(repaired_lines([row[2:4] for row in run], best[1], best[2]))
            out.append((key, *_found(facts, best, hashlib.sha256(lines.encode()).hexdigest()), *[None] * 5))

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not started or row[0] != key:
                    if not cut:
                        repair_run()
                    # the first conversation may have begun in the range before
                    run, key, cut, started = [], row[0], not started, True
                if not cut:
                    run.append(row)
                    cut = len(run) > size
                    if cut:
                        set_apart(run)
                        run = []
                else:
                    set_apart([row])
                if len(out) >= 2_000:
                    yield _batch(fields, out)
                    out = []
        set_apart(run)  # the last one may go on in the range after
        if out:
            yield _batch(fields, out)

    dealt = rows.repartitionByRange(*order).withColumn("place", F.spark_partition_id())
    return dealt.sortWithinPartitions("place", *order).mapInArrow(repaired, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _segments(rows: DataFrame, kind: str) -> DataFrame:
    """For each segment (conv, part): its facts, and its parses from every stack."""
    schema = f"conv {kind}, part long, facts string, parses string"
    fields = _arrow(schema)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar()
        stacks = grammar.stacks()
        numbers = {stack: i for i, stack in enumerate(stacks)}
        for (conv, part), run in _runs(batches, ("conv", "part")):
            kinds, facts = examined((row[3:6] for row in run), (row[6] for row in run))
            parses = [
                [(numbers[reached], *best) for reached, best in grammar.parse(kinds, {stack: (0, "", "")}).items()]
                for stack in stacks
            ]
            yield _batch(fields, [(conv, part, json.dumps(vars(facts)), json.dumps(parses))])

    dealt = rows.repartition("conv", "part").sortWithinPartitions("conv", "part", "number")
    return dealt.select("conv", "part", "number", "turn", "role", "text", "later").mapInArrow(parsed, schema)


def _batch(fields: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(list(c), f.type) for f, c in zip(fields, zip(*rows))]
    return pa.RecordBatch.from_arrays(arrays, names=fields.names)


def _chained(segments: DataFrame, kind: str) -> DataFrame:
    """Per conversation its result without the digest, per segment the edits chosen for it."""
    schema = f"conv {kind}, part long, audit string, left string, result string"
    fields = _arrow(schema)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar()
        stacks = grammar.stacks()
        for (conv,), run in _runs(batches, ("conv",)):
            facts = Facts()
            # of each stack: the best parse, and the way to it as (parse of the last segment, way before)
            heads = {stacks.index(s): (best, None) for s, best in grammar.initial().items()}
            opening = dict(heads)
            for _, part, counted, parses in run:
                facts = facts.then(Facts(**json.loads(counted)))
                after: dict[int, tuple] = {}
                table = json.loads(parses)
                for stack, (best, way) in heads.items():
                    for reached, cost, audit, left in table[stack]:
                        new = (best[0] + cost, best[1] + audit, best[2] + left)
                        if reached not in after or new < after[reached][0]:
                            after[reached] = (new, (part, audit, left, stack, way))
                heads = after
            end = stacks.index((grammar.moves[0, grammar.start], (0, None)))
            best, way = heads[end]
            chosen = []
            while way is not None:
                part, audit, left, stack, before = way
                chosen.append([part, audit, left])
                way = before
            start = opening[stack][0]  # insertions before the first row
            chosen[-1][1:] = start[1] + chosen[-1][1], start[2] + chosen[-1][2]
            rows = [(conv, *c, None) for c in reversed(chosen)]
            yield _batch(fields, [*rows, (conv, None, None, None, json.dumps(_found(facts, best, "")))])

    dealt = segments.repartition("conv").sortWithinPartitions("conv", "part")
    return dealt.mapInArrow(chained, schema)


def _digests(rows: DataFrame, chosen: DataFrame, kind: str) -> DataFrame:
    """conv, digest of the repaired lines: segments make their lines, one task hashes them in order."""
    lines_schema, digest_schema = f"conv {kind}, part long, lines string", f"conv {kind}, digest string"
    lines_fields, digest_fields = _arrow(lines_schema), _arrow(digest_schema)

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, part), run in _runs(batches, ("conv", "part")):
            lines = repaired_lines([row[3:5] for row in run], run[0][5], run[0][6])
            text = list(lines)
            yield _batch(lines_fields, [(conv, part, "\n".join(text) if text else None)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, current, lines = None, None, 0
        for batch in batches:
            for conv, _, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if running is None or conv != current:
                    if running is not None:
                        yield _batch(digest_fields, [(current, running.hexdigest())])
                    running, current, lines = hashlib.sha256(), conv, 0
                if text is not None:
                    running.update((("\n" if lines else "") + text).encode())
                    lines += 1
        if running is not None:
            yield _batch(digest_fields, [(current, running.hexdigest())])

    edits = chosen.select(F.col("conv").alias("of"), F.col("part").alias("part_of"), "audit", "left")
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("part") == F.col("part_of"))
    dealt = rows.join(edits, same).select("conv", "part", "number", "role", "text", "audit", "left")
    lines = dealt.repartition("conv", "part").sortWithinPartitions("conv", "part", "number")
    lines = lines.mapInArrow(applied, lines_schema)
    return lines.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(hashed, digest_schema)


def repair(
    rows: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """conv and the columns of ``FOUND``: one row per conversation that has rows.

    Rows are taken by turn, those without one first, rows of one turn by role and text. A null role
    or text counts as one space, so such a row has no initial or is blank. Rows without a
    conversation form one. Repeated rows are duplicates of the first. The empty table gives no rows.
    Other columns are not read. A conversation may have more rows than a task can hold; only its audit,
    which is one cell of the result, and the hash over its lines are made in one task, the
    latter as a stream.
    """
    taken = ordered(rows, id_column, turn_column, role_column, text_column)
    kind = taken.schema["conv"].dataType.simpleString()
    first = materialise(_inside_ranges(taken, kind), "conversations")
    names = ["conv", *FOUND_NAMES]
    whole = first.filter("part IS NULL").select(*names)
    cut = first.filter("part IS NOT NULL").select("conv", "part", "number", "turn", "role", "text")
    # the first of equal rows of a conversation; its place is one number, ranges in order
    place = F.shiftleft(F.shiftright("part", RANGE), 40) + F.col("number")
    several = cut.groupBy("conv", "role", "text").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    several = several.filter("n > 1").select(
        F.col("conv").alias("of"), F.col("role").alias("role_of"), F.col("text").alias("text_of"), "first"
    )
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("role") == F.col("role_of")) & (F.col("text") == F.col("text_of"))
    marked = materialise(
        cut.join(several, same, "left")
        .withColumn("later", F.coalesce(place != F.col("first"), F.lit(False)))
        .select(*cut.columns, "later"),
        "conversation-rows",
    )
    chained = materialise(_chained(_segments(marked, kind), kind), "conversation-edits")
    digests = _digests(marked, chained.filter("part IS NOT NULL"), kind).select(F.col("conv").alias("of"), "digest")
    results = chained.filter("part IS NULL").join(digests, F.col("conv").eqNullSafe(F.col("of")))
    fields = F.from_json("result", "array<string>")
    kinds = {part.split()[0]: part.split()[1] for part in FOUND.split(", ")}
    parts = [fields[i].cast(kinds[name]).alias(name) for i, name in enumerate(FOUND_NAMES[:-1])]
    return whole.unionByName(results.select("conv", *parts, F.col("digest").alias(FOUND_NAMES[-1])))


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with the faults that the hash of conversation and turn asks for.

    Nulls become one space: in the hashed key, and in roles and texts. A turn stays null.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), fault.alias("fault"))
        .filter("fault != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.translate("text", ENDS, ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def with_all(found: DataFrame, ids: Column, rows: DataFrame) -> DataFrame:
    """``found`` with a row of zeros for every conversation of ``rows`` that it does not hold."""
    nothing = hashlib.sha256(b"").hexdigest()
    known = rows.select(ids.alias("of")).distinct()
    joined = known.join(found, F.col("of").eqNullSafe(F.col("conv")), "left")
    empty = {name: "" if name == "audit" else nothing if name == "repaired_sha256" else 0 for name in FOUND_NAMES}
    return joined.select(F.col("of").alias("conv"), *(F.coalesce(F.col(n), F.lit(v)).alias(n) for n, v in empty.items()))
