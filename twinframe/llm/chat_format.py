"""Chat formatting into budgeted windows of whole turns.

The template writes a turn as <|im_start|>role, a line feed, its text, <|im_end|>, a line feed. Inside roles and texts a backslash is written twice and
"<|" as "<\\|" (in roles a line feed as backslash n), so no text can open or close a turn and everything is read back as it was.

Tokens are the tokenizer's, template included. Its pattern parts at the line feed between two turns, so a window's tokens are the sum of its turns'.
Prefix sums of them choose the windows. The room of a conversation is the budget less its system turn (if it opens with one). The sums are cut on a grid of half
the room: a turn belongs to the cell in which it starts. A cell's last turn reaches beyond it; where the cell would then pass the room, that turn is a window of
its own. So a window passes the budget (`oversize`) only where the system turn and one turn of its own already do: turns are never cut.

A window repeats the system turn and those of the `history` turns before it, the nearest first, that still fit. It holds under loss the texts of its own assistant
turns only: repeated ones are masked, so each assistant text is a target once.

Turns are ordered by (turn, role, text), nulls first and among themselves by a hash; a null role or text is empty; rows may repeat; a null conv_id is a conversation
of its own. A conversation's turns are numbered and summed in two levels (blocks of turn numbers, then blocks), and its system turn is dealt to its windows in
portions, so one hot conversation is spread over many tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinframe.llm.byte_bpe import encode_text, encoder
from twinframe.llm.common import text_slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BUDGET = 1024
HISTORY = 2
#: Turn numbers of one block, and cells of one portion.
BLOCK, PORTION = 256, 1024
_NO_TURN = -(1 << 62)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def said(turns: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """conv_id, turn, role, said (the formatted turn), head and body (code points before and of its text) and tokens of every row of turns."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escaped(text)
    made = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.concat(head, body, F.lit(CLOSE + "\n")).alias("said"), F.length(head).alias("head"), F.length(body).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in batches:
            for rows in text_slices(batch, "said"):
                n = [len(encode_text(enc, t)) for t in rows.column(3).to_pylist()]
                yield pa.record_batch([*rows.columns, pa.array(n, pa.int64())], [*rows.schema.names, "tokens"])

    return made.mapInArrow(run, "conv_id long, turn long, role string, said string, head int, body int, tokens long")


def windows(turns: DataFrame, rank_file: str, pattern: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, n_repeated (leading turns repeated from before), loss (array of code point intervals of `formatted`), n_tokens, oversize, formatted."""
    rows = said(turns, rank_file, pattern)
    tie = F.when(F.col("turn").isNull(), F.xxhash64("said"))
    rows = rows.withColumns({"tie": tie, "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(_NO_TURN) + F.shiftright(tie, 56))})
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "tie", "role", "said").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_pos": F.count("*").over(within), "_sum": F.coalesce(F.sum("tokens").over(within), F.lit(0))})
    opens = F.max(F.when((F.col("_pos") == 0) & (F.col("role") == "system"), F.col("tokens")))
    blocks = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.coalesce(opens, F.lit(0)).alias("system"))
    whole = Window.partitionBy("conv_id").orderBy("block")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("_t"),
        F.first("system").over(whole).alias("system"), F.sum("t").over(Window.partitionBy("conv_id")).alias("total"),
    )
    rows = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    # a system turn takes no place on the grid
    room = F.greatest(F.lit(budget) - F.col("system"), F.lit(2))
    pos = F.col("_n") + F.col("_pos")
    leads = (pos == 0) & (F.col("role") == "system")
    at = F.greatest(F.col("_t") + F.col("_sum") - F.col("system"), F.lit(0))
    cell = F.floor(at / F.floor(room / 2))
    beyond = at + F.col("tokens") - cell * F.floor(room / 2) > room
    rows = rows.select(
        "conv_id", pos.alias("pos"), at.alias("at"), F.when(leads, F.lit(0).cast("long")).otherwise(2 * cell + beyond.cast("long")).alias("window"),
        leads.alias("leads"), "role", "said", "head", "body", "tokens", "system", F.floor(F.col("total") / F.floor(room / 2) / PORTION).alias("portions"),
    )

    turn = ("role", "said", "head", "body", "tokens")
    own = rows.select("conv_id", "window", "pos", F.lit(False).alias("repeated"), *turn)
    starts = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("window").alias("_window")).agg(
        F.min("pos").alias("start"), F.min(F.when(~F.col("leads"), F.col("at"))).alias("first"), F.sum("tokens").alias("own"), F.max("system").alias("_system")
    )
    starts = starts.where("start > 0")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    parts = [own, rows.where("leads").withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") + 1)))]
    parts[1] = parts[1].join(starts, same & (F.col("portion") == F.least(F.floor(F.col("_window") / 2 / PORTION), F.col("portions") + 1)))
    if history > 0:
        # from each window's start back to its history; what lies between the two in the sums has to fit
        wanted = starts.withColumn("_pos", F.explode(F.sequence(F.greatest(F.col("start") - history, F.lit(0)), F.col("start") - 1)))
        parts.append(rows.join(wanted, same & (F.col("pos") == F.col("_pos"))).where(~F.col("leads") & (F.col("first") - F.col("at") <= budget - F.col("_system") - F.col("own"))))
    every = own
    for part in parts[1:]:
        every = every.unionByName(part.select("conv_id", F.col("_window").alias("window"), "pos", F.lit(True).alias("repeated"), *turn))

    # A window's turns have several tokens each by the template, so a window within the budget is a bounded group.
    packed = every.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "said", "head", "body", "tokens", "repeated"))).alias("parts"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("loss"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["head"]
        target = F.array(F.struct(begin.alias("a"), (begin + p["body"]).alias("b"))).cast("array<struct<a:int,b:int>>")
        return F.struct((acc["at"] + F.length(p["said"])).alias("at"), F.when(~p["repeated"] & (p["role"] == "assistant"), F.concat(acc["loss"], target)).otherwise(acc["loss"]).alias("loss"))

    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"])
    return packed.select(
        "conv_id",
        "window",
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_repeated"),
        F.aggregate("parts", zero, step)["loss"].alias("loss"),
        total.alias("n_tokens"),
        (total > budget).alias("oversize"),
        F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("formatted"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from windows(): conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    Windows stream past in order and only running digests are kept, so a conversation may be longer than memory.
    """
    columns = ("conv_id", "window", "n_repeated", "loss", "formatted")
    dealt = formatted.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "window")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        done: list[tuple] = []
        turns = loss = None
        n = chars = size = count = 0

        def close() -> None:
            done.append((now[0], n, turns.hexdigest(), chars, loss.hexdigest(), size, count))

        for batch in batches:
            for rows in text_slices(batch, "formatted"):
                for conv, skip, spans, text in zip(*(rows.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                    if now is None or now[0] != conv:
                        if now is not None:
                            close()
                        now, turns, loss, n, chars, size, count = (conv,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
                    for k, m in enumerate(_TURN.finditer(text)):
                        if k >= skip:
                            turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                            n += 1
                    for s in spans:
                        plain = unescape(text[s["a"] : s["b"]])
                        loss.update(plain.encode())
                        chars += len(plain)
                    size += len(text)
                    count += 1
                yield from table(done)
                done.clear()
        if now is not None:
            close()
            yield from table(done)

    def table(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [f.split()[0] for f in schema.split(", ")])

    return dealt.mapInArrow(run, schema)
