"""Transcript parsing: lines of texts become the segments of a hidden Markov model that recovers the speakers' roles by Viterbi, and the turns
that come out of it are rendered in one canonical form."""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrasheaf.llm.common import join_counted, materialize

ROLES = ["system", "user", "assistant"]
# Speaker markers at the start of a line, by role.
MARKERS = {
    "system": r"<\|system\|>|\[system\]|#++[ \t]*+system[ \t]*+:?|system[ \t]*+(?:(?:prompt|message)[ \t]*+)?:",
    "user": r"<\|(?:user|prompter)\|>|\[(?:user|inst)\]|#++[ \t]*+(?:human|user|instruction|question)[ \t]*+:?|(?:user|human|customer|question|q|me)[ \t]*+:",
    "assistant": r"<\|assistant\|>|\[(?:assistant|/inst)\]|#++[ \t]*+(?:assistant|response|answer)[ \t]*+:?|(?:assistant|ai|bot|agent|gpt|answer|a)[ \t]*+:",
}
MARKED = re.compile(r"^[ \t]*+(?:" + "|".join(f"(?P<{role}>{pattern})" for role, pattern in MARKERS.items()) + r")\s*", re.IGNORECASE | re.MULTILINE)
FENCE = re.compile(r"^[ \t]*```", re.MULTILINE)
ASKS, LISTED, CODE = re.compile(r"\?\s*\Z"), re.compile(r"^[^\S\n]*+(?:[-*•]|\d++[.)])\s", re.MULTILINE), re.compile(r"```|^ {4}\S", re.MULTILINE)
#: How often, before any counting, a marker is taken to have been seen with its role, and any value with any role; the chance that a marked
#: line within a text only quotes a marker, and that the next turn's role is not what is usual.
MARKER_PRIOR, PRIOR, QUOTED, UNUSUAL = 1_000_000.0, 0.5, 0.01, 0.02
#: Features of a segment beside its marker, and how many values each has.
FEATURES = {"length": 24, "lines": 13, "asks": 2, "listed": 2, "code": 2}
#: Turn numbers of one conversation whose segments are counted together, and about how many segments a task decodes together.
BLOCK_TURNS, BLOCK_ROWS = 1024, 1024
BLOCK = ["block", "sub", "chunk", "giant", "piece"]
IMPOSSIBLE = -1e30


def cut(text: str) -> list[tuple[int, int, int, int]]:
    """The segments of a text, each up to the next line that a speaker's marker opens: (start, end, marker, where what it says starts).

    Lines without a marker can't begin a turn, so they belong to the segment before; marker 0 is none, else one more than its role. What lies
    between fences of code is no marker, nor is a second marker in a line; blank lines before the first marker belong to it."""
    fences = [m.start() for m in FENCE.finditer(text)]
    fences = fences[: len(fences) // 2 * 2]  # the last is not closed
    found = [(m.start(), ROLES.index(m.lastgroup) + 1, m.end()) for m in MARKED.finditer(text) if bisect(fences, m.start()) % 2 == 0]
    if not found or text[: found[0][0]].strip():
        found.insert(0, (0, 0, 0))
    starts = [0, *(start for start, _, _ in found[1:])]
    ends = [*starts[1:], len(text)]
    return [(start, end, marker, says) for start, end, (_, marker, says) in zip(starts, ends, found, strict=True)]


def features(text: str) -> list[int]:
    """A segment's length, its lines, and how it ends and looks, as numbers below those in ``FEATURES``."""
    return [min(23, int(log2(len(text) + 1) * 2)), min(12, text.count("\n") + 1), int(bool(ASKS.search(text))), int(bool(LISTED.search(text))), int(bool(CODE.search(text)))]


def segments_of(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but for its text, with part, parts, marker and the features of every segment of each text."""
    numbers = ["part", "parts", "marker", *FEATURES]
    given = rows.drop("text")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                found = cut(text)
                for k, (_, end, marker, says) in enumerate(found):
                    at.append(i)
                    said = text[says:end] if end == len(text) else text[says : max(says, end - 1)]  # without the line break at its end
                    values.append((k, len(found), marker, *features(said)))
            columns = list(zip(*values, strict=True)) if values else [()] * len(numbers)
            kept = batch.select(range(batch.num_columns - 1)).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, pa.int32()) for c in columns)], names=[*kept.schema.names, *numbers])

    ddl = ", ".join([f"{n} {t}" for n, t in given.dtypes] + [f"{n} int" for n in numbers])
    return rows.select(*given.columns, "text").mapInArrow(parse, ddl)


class RoleModel:
    """Log probabilities of starts, steps and what segments show. States 0 to 2 begin a turn of a role, 3 to 5 continue one."""

    def __init__(self, starts: dict[str, int], steps: dict[tuple[str, str], int], values: dict[tuple[str, str, int], int]):
        s = np.array([starts.get(r, 0) + PRIOR for r in ROLES])
        t = np.array([[steps.get((a, b), 0) + PRIOR for b in ROLES] for a in ROLES])
        t = (1 - UNUSUAL) * t / t.sum(axis=1, keepdims=True) + UNUSUAL / 3
        self.start = np.concatenate([np.log(s / s.sum()), [IMPOSSIBLE] * 3])
        onward = np.hstack([np.log((1 - QUOTED) * t), np.where(np.eye(3, dtype=bool), np.log(QUOTED), IMPOSSIBLE)])
        self.step = np.vstack([onward, onward])
        self.show = {name: np.log(e / e.sum(axis=1, keepdims=True)) for name, n in FEATURES.items() for e in [np.array([[values.get((r, name, v), 0) + PRIOR for v in range(n)] for r in ROLES])]}
        own = MARKER_PRIOR * np.eye(4)[1:]
        first = np.array([[values.get((r, "marker", v), 0) + PRIOR for v in range(4)] for r in ROLES]) + own
        inner = own[:, 1:] + PRIOR
        self.first, self.inner = np.log(first / first.sum(axis=1, keepdims=True)), np.log(inner / inner.sum(axis=1, keepdims=True))

    def emissions(self, segments: pd.DataFrame) -> np.ndarray:
        """The log probability of segments in each state. The first segment of a text begins a turn, the others have a marker, which in one
        that continues a turn says nothing of the role."""
        said = sum(table[:, segments[name].to_numpy()].T for name, table in self.show.items())
        first, marker = segments["part"].to_numpy()[:, None] == 0, segments["marker"].to_numpy()
        begins = said + np.where(first, self.first[:, marker].T, self.inner[:, np.maximum(marker, 1) - 1].T)
        return np.hstack([begins, np.where(first, IMPOSSIBLE, said - np.log(3))])


def learn(segments: DataFrame) -> RoleModel:
    """Counts over (conv_id, loose, turn, role, part, parts, marker, features): first turns, pairs of turns that follow each other, and what
    texts of one segment show by role. All results are small tables of constants."""
    known = segments.where(F.col("role").isin(ROLES) & (F.col("part") == 0))
    names = ["marker", *FEATURES]
    pairs = known.where("parts = 1").select("role", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names))).alias("x"))
    values = {(r["role"], r["name"], r["value"]): r["n"] for r in pairs.groupBy("role", "x.name", "x.value").agg(F.count(F.lit(1)).alias("n")).collect()}
    turns = known.where("turn >= 0 AND NOT loose").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    steps = {(r["role"], r["next"]): r["n"] for r in turns.join(after, ["conv_id", "turn"]).groupBy("role", "next").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = {r["role"]: r["n"] for r in turns.where("turn = 0").groupBy("role").agg(F.count(F.lit(1)).alias("n")).collect()}
    return RoleModel(starts, steps, values)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def block_matrix(emissions: np.ndarray, step: np.ndarray) -> np.ndarray:
    """M[i, j]: the best log probability of a block's path that starts in state i (its first emission included) and ends in j."""
    out = np.full(step.shape, -np.inf)
    np.fill_diagonal(out, emissions[0])
    for e in emissions[1:]:
        out = max_plus(out, step) + e
    return out


def best_path(emissions: np.ndarray, step: np.ndarray, first: int, last: int) -> list[int]:
    """The best path of a block between two given states; ties go to the lower state."""
    score = np.full(len(step), -np.inf)
    score[first] = emissions[0, first]
    back = []
    for e in emissions[1:]:
        options = score[:, None] + step
        back.append(options.argmax(axis=0))
        score = options.max(axis=0) + e
    path = [last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def block_ends(matrices: list[np.ndarray], start: np.ndarray, step: np.ndarray) -> list[tuple[int, int]]:
    """First and last state of every block of a conversation on the best path through all of them."""
    score, back = start, []
    for k, m in enumerate(matrices):
        into = score[:, None] + step if k else np.where(np.eye(len(step), dtype=bool), score[:, None], -np.inf)
        entry, entry_score = into.argmax(axis=0), into.max(axis=0)
        through = entry_score[:, None] + m
        back.append((entry, through.argmax(axis=0)))
        score = through.max(axis=0)
    last, ends = int(score.argmax()), []
    for entry, first_of in reversed(back):
        first = int(first_of[last])
        ends.append((first, last))
        last = int(entry[first])
    return ends[::-1]


def in_blocks(rows: DataFrame) -> DataFrame:
    """Adds ``BLOCK``, which cut each conversation in order of (turn, row_id, part) into blocks of about ``BLOCK_ROWS`` segments.

    Turn numbers that go together by number do so if they are few segments; else turns are dealt by how many segments come before them among
    those numbers, and a turn of more than a block is cut by the hash that begins row_id. Texts of more than two blocks come after all others of their turn and are cut by parts."""
    block = F.floor(F.col("turn") / BLOCK_TURNS).cast("long")
    counts = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("__n")).withColumn("block", block)
    whole = Window.partitionBy("conv_id", "block")
    before = F.coalesce(F.sum("__n").over(whole.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    large = counts.select("conv_id", "turn", "__n", F.sum("__n").over(whole).alias("__all"), before.alias("__before")).where(F.col("__all") > 2 * BLOCK_ROWS).drop("__all")
    hashed = F.conv(F.hex(F.substring("row_id", 1, 4)), 16, 10).cast("long")
    giant = F.col("parts") > 2 * BLOCK_ROWS
    chunk = F.when(giant, F.lit(1 << 40)).when(F.col("__n") > BLOCK_ROWS, 1 + F.shiftright(hashed * F.ceil(F.col("__n") / BLOCK_ROWS), 32))
    placed = rows.join(large, ["conv_id", "turn"], "left")
    sub = F.coalesce(F.floor(F.col("__before") / BLOCK_ROWS), F.lit(0)).cast("long")
    piece = F.when(giant, F.floor(F.col("part") / BLOCK_ROWS).cast("long")).otherwise(0)
    keys = {"block": block, "sub": sub, "chunk": F.coalesce(chunk, F.lit(0)).cast("long"), "giant": F.when(giant, F.hex("row_id")).otherwise(""), "piece": piece.cast("long")}
    return placed.withColumns(keys).drop("__n", "__before")


def recover_roles(segments: DataFrame, model: RoleModel) -> DataFrame:
    """(row_id, n, part, state) of each segment (conv_id, turn, row_id, n, part, parts, marker, features) on the best path through its
    conversation; n is handed on.

    Conversations are decoded in blocks (``in_blocks``), in three steps: each block's max-plus matrix, one small row for a block; each
    conversation's best way through its blocks' matrices; and each block's path between the states found for its ends. The result is the same
    as that of one pass; a task holds the segments of a batch or a block, whatever the turn numbers are, and one small row for each block of
    the conversation at hand.
    """
    rows = in_blocks(segments)
    step, start = model.step, model.start
    order = ["turn", "row_id", "part"]

    def matrices_of(pdf: pd.DataFrame, starts: list[int], stops: list[int]) -> pd.DataFrame:
        e = model.emissions(pdf)
        firsts = pdf.iloc[starts]
        return pd.DataFrame({"conv_id": firsts["conv_id"].to_numpy(), **{k: firsts[k].to_numpy() for k in BLOCK}, "m": [block_matrix(e[a:b], step).ravel().tolist() for a, b in zip(starts, stops, strict=True)]})

    def ends_of(pdf: pd.DataFrame, starts: list[int], stops: list[int]) -> pd.DataFrame:
        m = [np.array(x).reshape(step.shape) for x in pdf["m"]]
        found = [x for a, b in zip(starts, stops, strict=True) for x in block_ends(m[a:b], start, step)]
        return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), **{k: pdf[k].to_numpy() for k in BLOCK}, "first": [a for a, _ in found], "last": [b for _, b in found]})

    def paths_of(pdf: pd.DataFrame, starts: list[int], stops: list[int]) -> pd.DataFrame:
        e, first, last = model.emissions(pdf), pdf["first"].tolist(), pdf["last"].tolist()
        return pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "n": pdf["n"].to_numpy(), "part": pdf["part"].to_numpy(), "state": [x for a, b in zip(starts, stops, strict=True) for x in best_path(e[a:b], step, first[a], last[a])]})

    keys, ddl = ["conv_id", *BLOCK], "conv_id string, block long, sub long, chunk long, giant string, piece long"
    matrices = in_groups(rows, keys, order, matrices_of, f"{ddl}, m array<double>")
    bounds = materialize(in_groups(matrices, ["conv_id"], BLOCK, ends_of, f"{ddl}, first int, last int"), "block-ends")
    return in_groups(rows.join(bounds, keys), keys, order, paths_of, "row_id binary, n long, part int, state int")


def in_groups(df: DataFrame, keys: list[str], order: list[str], work: Callable[[pd.DataFrame, list[int], list[int]], pd.DataFrame], schema: str) -> DataFrame:
    """Runs ``work`` on many whole groups at a time: rows are dealt and sorted by key, and ``work`` gets a batch with where its groups start
    and stop. The last group of a batch waits for the next one."""
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if held and pdf[keys].iloc[-1].equals(held[0][keys].iloc[0]) and pdf[keys].drop_duplicates().shape[0] == 1:
                held.append(pdf)  # all of it continues the waiting group
                continue
            pdf = pd.concat([*held, pdf], ignore_index=True) if held else pdf
            starts = np.flatnonzero((pdf[keys] != pdf[keys].shift()).any(axis=1))
            if len(starts) > 1:
                yield work(pdf.iloc[: starts[-1]], starts[:-1].tolist(), starts[1:].tolist())
            held = [pdf.iloc[starts[-1] :]] if len(starts) else []
        if held:
            last = pd.concat(held, ignore_index=True)
            yield work(last, [0], [len(last)])

    return placed.mapInPandas(run, schema)


def turns_of(text: str, states: list[int]) -> list[tuple[int, bool, str]]:
    """(role, whether a marker opens it, what is said) of each turn of a text: segments that continue a turn are joined to it, the marker that
    opens a turn and the line break before the next go."""
    found = cut(text)
    begins = [k for k, state in enumerate(states) if state < 3]
    out = []
    for k, after in zip(begins, [*begins[1:], len(found)], strict=True):
        said = text[found[k][3] : found[after - 1][1]]
        out.append((states[k], found[k][2] > 0, said if after == len(found) else said.rstrip()))
    return out


def rendered(rows: DataFrame) -> DataFrame:
    """The turns of texts whose segments' states are known: conv_id, turn, part, held_out, role, given_role, had_marker and rendered."""
    id_type = rows.schema["id"].dataType.simpleString()
    schema = pa.schema([("conv_id", pa.int64() if id_type == "bigint" else pa.string()), ("turn", pa.int64()), ("part", pa.int32()), ("held_out", pa.bool_()), ("role", pa.string()), ("given_role", pa.string()), ("had_marker", pa.bool_()), ("rendered", pa.string())])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                for k, (role, marked, said) in enumerate(turns_of(r["text"], r["states"])):
                    out.append((r["id"], r["given_turn"], k, r["held_out"], ROLES[role], r["role"], marked, f"<|{ROLES[role]}|>\n{said}<|end|>\n"))
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.select("id", "given_turn", "held_out", "role", "text", "states").mapInArrow(render, f"conv_id {id_type}, turn long, part int, held_out boolean, role string, given_role string, had_marker boolean, rendered string")


def format_chats(conversations: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """conv_id, turn, part, held_out, role (recovered), given_role, had_marker and rendered, for every turn found in every row's text.

    A text is cut into segments at lines that open with a speaker's marker (``cut``). Each begins a turn of some role or, but for the first,
    continues the one before, and the best path through the whole conversation says which. part numbers the turns within a row. Learns from
    rows whose crc32 of conv_id is not ``part`` modulo ``parts``; decoding never sees given roles. A turn is rendered as <|role|>, newline,
    text without the marker that opens it, <|end|>, newline.

    Null text is empty and one turn; a null turn number comes before all others; a row with a null conv_id is decoded by itself; equal turn
    numbers are ordered by the hash of the text, and copies of a row share their roles; unknown given roles teach nothing; a conv_id that is
    no whole number is taken and returned as text; no rows give no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    numbered = dict(conversations.dtypes)["conv_id"] in ("tinyint", "smallint", "int", "bigint")
    rows = conversations.select(F.col("conv_id").cast("long" if numbered else "string").alias("id"), F.col("conv_id").cast("string").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.col("turn").cast("long").alias("given_turn"), F.col("role").cast("string").alias("role"), text.alias("text"))
    place = F.md5(F.concat_ws(":", F.coalesce("conv_id", F.lit("")), "turn", F.col("conv_id").isNull().cast("string")).cast("binary"))
    row_id = F.unhex(F.concat(F.substring(F.sha2(F.col("text"), 256), 1, 32), F.substring(place, 1, 16)))
    held = F.crc32(F.coalesce("conv_id", F.lit("null")).cast("binary")) % parts == part
    rows = rows.select("*", row_id.alias("row_id"), held.alias("held_out"))
    keyed = rows.select("row_id", F.coalesce("conv_id", F.hex("row_id")).alias("conv_id"), F.col("conv_id").isNull().alias("loose"), "turn", "role", "held_out", "text")
    parsed = materialize(segments_of(keyed), "parsed")
    model = learn(parsed.where(~F.col("held_out")))
    shown = ["conv_id", "turn", "parts", "marker", *FEATURES]
    single = materialize(parsed.groupBy("row_id", "part").agg(F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in shown)), "segments")
    found = recover_roles(single, model)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("part", "state"))), lambda x: x["state"])
    states = materialize(found.groupBy("row_id").agg(F.max("n").alias("n"), in_order.alias("states")), "states")
    return rendered(join_counted(rows, states, "row_id", "n"))
