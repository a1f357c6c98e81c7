"""Repair of conversation structure: the cheapest edits that make the roles alternate.

A row is a symbol: its role and its first fault. Four states say how the repaired conversation
ends so far; a symbol's transition between them is a four by four table of the cheapest edits
(insertions first, then one of delete, keep, rerole), in the min-plus algebra. Equal consecutive
symbols are one run, which advances by binary powers of its table; powers are kept per worker.
For each pair of states a power keeps its cost, the state half-way, and how its edits rank among
those from the same state, so ties go to the least text without texts being kept; the edits are
unrolled at the end.

Edits of as many rows, from one state, are texts of which none begins with another, since each
row ends with one of D, K, R. So a comparison is decided by the first half in which two differ.

A long conversation is cut into blocks of rows. Each block becomes one table; the tables of a
conversation fix the states at the blocks' edges; then the blocks are unrolled on their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.llm import common, places

# The price of each edit, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAULTS = ("blank", "duplicate", "truncated")
#: Rows of a block.
BLOCK_ROWS = 1 << 14

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The states after a role's initial, where it may follow.
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The one role of user and assistant that may follow a state.
_NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: Insertions that finish a conversation.
_FINISH = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_NAMES = {"u": "user", "a": "assistant"}
_ROW_EDITS = re.compile("I*[DKR]")

#: A table: for each state, the reachable states as state -> (cost, rank, half-way state or edits).
Table = list[dict[int, tuple[int, int, object]]]


def symbol_table(role: str, fault: str) -> Table:
    """The cheapest edits of one row between two states."""
    table: Table = []
    for state in STATES:
        found: dict[int, tuple[int, str]] = {}
        now = state
        for inserted in range(3):  # two insertions reach every state
            cost, edits = INSERT * inserted, "I" * inserted
            options = [(now, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                options.append((_AFTER[now, _NEXT[now]], REROLE + extra, "R"))
                if (now, role) in _AFTER:
                    options.append((_AFTER[now, role], KEEP + extra, "K"))
            for after, price, edit in options:
                option = (cost + price, edits + edit)
                if after not in found or option < found[after]:
                    found[after] = option
            now = _AFTER[now, _NEXT[now]]
        texts = sorted(edits for _, edits in found.values())
        table.append({after: (cost, texts.index(edits), edits) for after, (cost, edits) in found.items()})
    return table


def joined(first: Table, second: Table) -> Table:
    """The table of the first rows and then the second ones; the third entry is the state between."""
    out: Table = []
    for state in STATES:
        best: dict[int, tuple[int, int, int, int]] = {}
        for between, (cost, rank, _) in first[state].items():
            for after, (more, rank2, _) in second[between].items():
                option = (cost + more, rank, rank2, between)
                if after not in best or option < best[after]:
                    best[after] = option
        order = sorted(best, key=lambda after: best[after][1:3])
        out.append({after: (best[after][0], place, best[after][3]) for place, after in enumerate(order)})
    return out


class Powers:
    """Tables of 1, 2, 4 .. equal symbols, made when first needed."""

    def __init__(self):
        self.tables: dict[tuple[str, str], list[Table]] = {}
        self.texts: dict[tuple, str] = {}

    def table(self, symbol: tuple[str, str], power: int) -> Table:
        known = self.tables.setdefault(symbol, [])
        if not known:
            known.append(symbol_table(*symbol))
        while len(known) <= power:
            known.append(joined(known[-1], known[-1]))
        return known[power]

    def edits(self, symbol: tuple[str, str], power: int, state: int, after: int) -> str:
        """The edits of ``2 ** power`` rows between two states."""
        key = (symbol, power, state, after)
        found = self.texts.get(key)
        if found is None:
            middle = self.table(symbol, power)[state][after][2]
            found = middle if not power else self.edits(symbol, power - 1, state, middle) + self.edits(symbol, power - 1, middle, after)
            if power < 8:
                self.texts[key] = found
        return found


POWERS = Powers()


def segments(symbols: Sequence[tuple[str, str]]) -> list[tuple[tuple[str, str], int]]:
    """Runs of equal symbols, each as binary powers, the largest first."""
    out = []
    i = 0
    while i < len(symbols):
        j = i
        while j < len(symbols) and symbols[j] == symbols[i]:
            j += 1
        count = j - i
        out += [(symbols[i], p) for p in range(count.bit_length() - 1, -1, -1) if count >> p & 1]
        i = j
    return out


def block_table(parts: Sequence[tuple[tuple[str, str], int]]) -> Table:
    """One table of all rows of a block."""
    done = None
    for symbol, power in parts:
        table = POWERS.table(symbol, power)
        done = table if done is None else joined(done, table)
    return done


def ahead(tables: Sequence[Table], last: Sequence[float]) -> list[list[float]]:
    """For each table and state the least cost of it and all that follows; ``last`` is beyond them."""
    costs = [list(last)]
    for table in reversed(tables):
        after = costs[-1]
        costs.append([min((cost + after[s] for s, (cost, _, _) in row.items()), default=float("inf")) for row in table])
    return costs[::-1]


def path(tables: Sequence[Table], state: int, last: Sequence[float]) -> list[int]:
    """The states from ``state`` on, of the cheapest edits; ties go to the least text."""
    costs = ahead(tables, last)
    states = [state]
    for table, after in zip(tables, costs[1:]):
        row = table[states[-1]]
        states.append(min(row, key=lambda s: (row[s][0] + after[s], row[s][1])))
    return states


FINISH = [INSERT * _FINISH[s] for s in STATES]


def block_edits(symbols: Sequence[tuple[str, str]], state: int, end: int | None) -> tuple[list[str], int]:
    """Each row's edits from ``state`` to ``end`` (without one: to the conversation's end), and the last state."""
    parts = segments(symbols)
    last = FINISH if end is None else [0 if s == end else float("inf") for s in STATES]
    states = path([POWERS.table(*part) for part in parts], state, last)
    text = "".join(POWERS.edits(*part, a, b) for part, a, b in zip(parts, states, states[1:]))
    return _ROW_EDITS.findall(text), states[-1]


def walk(state: int, edits: str, role: str) -> tuple[int, str, str | None]:
    """What one row's edits do from a state: the state after, inserted initials, the role it gets.

    Without a role the row is deleted.
    """
    inserted = ""
    for edit in edits[:-1]:
        inserted += _NEXT[state]
        state = _AFTER[state, _NEXT[state]]
    if edits[-1] == "D":
        return state, inserted, None
    initial = role if edits[-1] == "K" else _NEXT[state]
    return _AFTER[state, initial], inserted, initial


# Tables


def numbered_rows(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a number of the ``row``, written once; a null role or text is one space."""
    rows = messages.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row"),
    )
    return common.written(rows, "messages")


def faults(rows: DataFrame) -> DataFrame:
    """row, conv_id, turn, role, ``same`` (a hash of role and text) and ``fault``, without the texts.

    The fault is blank, duplicate, truncated or null. A row is a duplicate if an earlier one of
    its conversation has its role and text; of rows that share their turn as well, all but one.
    Only the first row of each text is looked up, by its own number, so a text that fills a
    conversation does not meet in one task.
    """
    same = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    end = F.right(F.rtrim("text", F.lit(common.SPACE_CHARS)), F.lit(1))
    look = F.when(end == "", "blank").when(~end.isin(".", "!", "?"), "truncated")
    narrow = rows.select("row", "conv_id", "turn", "role", same.alias("same"), look.alias("look"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row")
    first = narrow.groupBy("conv_id", "same").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"), F.lit(True).alias("is_first"))
    fault = F.when(F.col("look") == "blank", "blank").when(F.col("is_first").isNull(), "duplicate").otherwise(F.col("look"))
    return narrow.join(first.hint("merge"), "row", "left").select("row", "conv_id", "turn", "role", "same", fault.alias("fault"))


def _summaries(blocks: pd.DataFrame) -> pd.DataFrame:
    """A block's table as lists of costs and ranks, state by state; -1 where there is no way."""
    out = []
    for (start, block), part in blocks.sort_values(["start", "pos"]).groupby(["start", "block"], sort=False):
        table = block_table(segments(_symbols(part)))
        costs, ranks = [], []
        for row in table:
            costs += [row[s][0] if s in row else -1 for s in STATES]
            ranks += [row[s][1] if s in row else -1 for s in STATES]
        out.append((start, block, costs, ranks))
    return pd.DataFrame(out, columns=["start", "block", "costs", "ranks"])


def _symbols(rows: pd.DataFrame) -> list[tuple[str, str]]:
    """Roles and faults as far as they matter: a row that must go has no role, other initials are one."""
    return [
        ("-", fault) if fault in ("blank", "duplicate") else (role if role and role in "sua" else "-", fault or "")
        for role, fault in zip(rows["initial"].tolist(), rows["fault"].tolist())
    ]


def _edges(blocks: pd.DataFrame) -> pd.DataFrame:
    """The states at the edges of a conversation's blocks."""
    blocks = blocks.sort_values("block")
    tables = [
        [{s: (costs[4 * p + s], ranks[4 * p + s], None) for s in STATES if costs[4 * p + s] >= 0} for p in STATES]
        for costs, ranks in zip(blocks["costs"], blocks["ranks"])
    ]
    states = path(tables, START, FINISH)
    last = [None if i == len(tables) - 1 else s for i, s in enumerate(states[1:])]
    out = pd.DataFrame({"start": blocks["start"], "block": blocks["block"], "state": states[:-1]})
    out["end"] = pd.array(last, dtype="Int32")
    return out


def _unrolled(blocks: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """Each row's edits, inserted roles before it and after the last row, and its role."""
    known = {(e.start, e.block): (e.state, None if pd.isna(e.end) else int(e.end)) for e in edges.itertuples(index=False)}
    out = []
    for key, part in blocks.sort_values(["start", "pos"]).groupby(["start", "block"], sort=False):
        state, end = known.get(key, (START, None))
        edits, last = block_edits(_symbols(part), state, end)
        final = len(part) - 1
        rows = zip(*[part[c].tolist() for c in ("row", "start", "pos", "initial", "fault")], edits)
        for i, (row, start, pos, initial, fault, edit) in enumerate(rows):
            state, inserted, role = walk(state, edit, initial)
            tail = ""
            if i == final and end is None:
                for _ in range(_FINISH[last]):
                    tail += _NEXT[state]
                    state = _AFTER[state, _NEXT[state]]
            out.append((row, start, pos, fault, edit + "I" * len(tail), inserted, role, tail))
    return pd.DataFrame(out, columns=["row", "start", "pos", "fault", "edits", "before", "becomes", "after"])


_EDITS = "row bigint, start bigint, pos bigint, fault string, edits string, before string, becomes string, after string"


def repair(messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row with its fault and the edits that repair its conversation at least cost.

    conv_id, turn, role, text (null: one space), fault, edits (initials of Insert, then Delete,
    Keep or Rerole; Inserts at the end stand behind the last row's), before and after (initials of
    inserted roles), becomes (the role's initial after the edits, null if the row is deleted),
    start (a number of the conversation) and pos. Rows are ordered by turn, null first; rows that
    share a turn by role and a hash of the text. A null conv_id is a conversation; equal rows each count; a role
    without a first letter s, u or a cannot be kept; an empty table gives no rows; other columns
    are ignored.
    """
    rows = numbered_rows(messages)
    narrow = common.written(faults(rows).withColumn("conv", F.col("conv_id").cast("string")), "faults")
    placed = places.grouped(narrow.drop("conv_id"), "conv", ["turn", "role", "same", "row"])
    blocks = placed.select(
        "row", "start", "pos", F.substring("role", 1, 1).alias("initial"), "fault", "n", F.expr(f"pos div {block_rows}").alias("block")
    ).withColumn("pack", F.expr(f"(start + block * {block_rows}) div {block_rows}"))
    blocks = common.written(blocks, "placed")
    many = blocks.filter(F.col("n") > block_rows)
    tables = many.groupBy("pack").applyInPandas(_summaries, "start bigint, block bigint, costs array<bigint>, ranks array<bigint>")
    edges = tables.groupBy("start").applyInPandas(_edges, "start bigint, block bigint, state int, end int")
    edges = edges.withColumn("pack", F.expr(f"(start + block * {block_rows}) div {block_rows}"))
    edits = blocks.groupBy("pack").cogroup(edges.groupBy("pack")).applyInPandas(_unrolled, _EDITS)
    return rows.join(edits.hint("merge"), "row").select(
        "conv_id", "turn", "role", "text", "fault", "edits", "before", "becomes", "after", "start", "pos"
    )


_DIGEST = (
    "start bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string, conv string"
)


class Summary:
    """One conversation's counts, audit and digest, row by row in order."""

    def __init__(self, start: int, conv: str | None):
        self.start, self.conv = start, conv
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = self.turns = 0
        self.least = self.most = self.before = None
        self.audit: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def add(self, row: dict) -> None:
        turn, role, fault = row["turn"], row["role"], row["fault"]
        if turn is not None and turn != self.most:  # turns come in order, null first
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        self.audit.append(row["edits"])
        for initial in row["before"]:
            self.line(_NAMES[initial], "")
        if row["becomes"]:
            self.line(_NAMES[row["becomes"]] if "R" in row["edits"] else role, row["text"])
            self.cost += TRUNCATED if fault == "truncated" else 0
        for initial in row["after"]:
            self.line(_NAMES[initial], "")
        prices = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}
        self.cost += sum(prices[e] for e in row["edits"])

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.start, gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest(), self.conv
        )


def summaries(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: counts, cost, audit, digest of the repaired text.

    A digest over a conversation reads it in order, so its rows pass through one task, one at a
    time; no task holds a conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def out() -> pa.RecordBatch:
            columns = [pa.array(c) for c in zip(*done)]
            names = [c.split()[0] for c in _DIGEST.split(", ")]
            done.clear()
            columns = [c.cast(pa.string() if n in ("audit", "repaired_sha256", "conv") else pa.int64()) for n, c in zip(names, columns)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now.start != row["start"]:
                    if now is not None:
                        done.append(now.row())
                    now = Summary(row["start"], row["conv"])
                now.add(row)
            if len(done) >= 1000:
                yield out()
        if now is not None:
            done.append(now.row())
        if done:
            yield out()

    rows = repaired.select(
        "start", "pos", F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        "role", F.when(F.col("becomes").isNotNull(), F.col("text")).alias("text"), "fault", "edits", "before", "becomes", "after",
    )
    return rows.repartition("start").sortWithinPartitions("start", "pos").mapInArrow(run, _DIGEST)


def damaged(messages: DataFrame) -> DataFrame:
    """The rows of a table of conversations, some of them spoilt by a checksum of conversation and turn."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    role, text = text_of("role"), text_of("text")
    return (
        messages.select("conv_id", "turn", role.alias("role"), text.alias("text"), lot.alias("lot"))
        .filter("lot <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.expr("sequence(1, CASE WHEN lot = 3 THEN 2 ELSE 1 END)")).alias("copy"),
        )
        .drop("copy")
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = common.table(spark, sf_dir, "conversations")
    kind = dict(messages.dtypes)["conv_id"]
    found = summaries(repair(damaged(messages))).withColumn("found", F.col("conv").cast(kind)).drop("start", "conv")
    every = messages.select("conv_id").distinct()
    counts = ("gaps", *FAULTS, "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def op12_sql() -> str:
    """Row by row: the cheapest edits up to each row and state, then the edits read letter by letter.

    The checksum is worked out from the digits with the table of the polynomial.
    """
    blank = r"[^\x20\x09-\x0D]"
    crc = (
        "xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split("
        "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), "
        "lambda x: CAST(ascii(x) AS UBIGINT))), lambda c, x: xor(c // 256, crc.t[CAST(xor(c, x) % 256 + 1 AS BIGINT)])), 4294967295::UBIGINT)"
    )
    return f"""
    WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS UBIGINT)],
        CAST(range(8) AS UBIGINT[])), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
      FROM range(256) g(i))),
    lots AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, turn, coalesce(role, ' ') AS role,
        coalesce(text, ' ') AS text, {crc} % 20 AS lot FROM conversations, crc),
    spoilt AS (
      SELECT conv, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
      FROM lots WHERE lot <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role,
        sha256(strlen(role) || ':' || role || text), copy) AS i FROM spoilt),
    looked AS (SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS stop FROM placed),
    rows_ AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'blank' WHEN again THEN 'duplicate'
        WHEN stop NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM looked),
    counts AS (
      SELECT conv, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(i) AS n
      FROM (SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM rows_) GROUP BY conv),
    follows(state, initial, after) AS (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
    anew(state, after) AS (VALUES ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
    filled(state, after, k) AS (VALUES ('-', '-', 0), ('-', 'u', 1), ('-', 'a', 2), ('s', 's', 0), ('s', 'u', 1), ('s', 'a', 2),
      ('u', 'u', 0), ('u', 'a', 1), ('u', 'u', 2), ('a', 'a', 0), ('a', 'u', 1), ('a', 'a', 2)),
    options AS (
      SELECT conv, i, state, state AS after, 'D' AS edit, {DELETE} AS price FROM rows_, (SELECT DISTINCT state FROM anew)
      UNION ALL
      SELECT conv, i, state, after, 'R', {REROLE} + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END
      FROM rows_, anew WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
      UNION ALL
      SELECT conv, i, state, after, 'K', {KEEP} + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END
      FROM rows_ JOIN follows USING (initial) WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')),
    walk AS (
      SELECT conv, CAST(0 AS BIGINT) AS i, '-' AS state, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS best FROM counts
      UNION ALL
      SELECT conv, i, state, best FROM (
        SELECT w.conv, o.i, o.after AS state,
          min({{'cost': CAST(w.best.cost + {INSERT} * f.k + o.price AS BIGINT), 'audit': w.best.audit || repeat('I', f.k) || o.edit}}) AS best
        FROM walk w JOIN filled f ON f.state = w.state JOIN options o ON o.conv = w.conv AND o.i = w.i + 1 AND o.state = f.after
        GROUP BY w.conv, o.i, o.after)),
    done AS (
      SELECT conv, min({{'cost': best.cost + {INSERT} * k, 'audit': best.audit || repeat('I', k)}}) AS best
      FROM walk JOIN counts USING (conv) JOIN (VALUES ('-', 0), ('s', 2), ('u', 1), ('a', 0)) e(state, k) USING (state)
      WHERE i = n GROUP BY conv),
    decoded AS (
      SELECT conv, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS i, '-' AS state, CAST(NULL AS VARCHAR) AS line FROM done
      UNION ALL
      SELECT d.conv, d.j + 1, d.i + CASE WHEN e.edit = 'I' THEN 0 ELSE 1 END,
        CASE e.edit WHEN 'D' THEN d.state WHEN 'K' THEN r.initial ELSE a.after END,
        CASE e.edit WHEN 'D' THEN NULL WHEN 'K' THEN r.role || ':' || r.text
          ELSE CASE a.after WHEN 'u' THEN 'user:' ELSE 'assistant:' END || CASE WHEN e.edit = 'I' THEN '' ELSE r.text END END
      FROM decoded d JOIN (SELECT conv, best.audit AS audit FROM done) x ON x.conv = d.conv AND d.j < length(x.audit),
        LATERAL (SELECT substr(x.audit, d.j + 1, 1) AS edit) e
        JOIN anew a ON a.state = d.state LEFT JOIN rows_ r ON r.conv = d.conv AND r.i = d.i + 1),
    texts AS (SELECT conv, sha256(coalesce(string_agg(line, chr(10) ORDER BY j), '')) AS digest FROM decoded GROUP BY conv),
    every AS (SELECT DISTINCT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv FROM conversations)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
      coalesce(best.audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
    FROM every LEFT JOIN counts USING (conv) LEFT JOIN done USING (conv) LEFT JOIN texts USING (conv)"""
