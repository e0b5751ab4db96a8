"""Preference formatting: a shared prompt and two masked completions for each pair of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): the turns of each conversation in order.

    Repeated rows count once; turns of one number are ordered by role, then text. NULL role and
    text are empty; rows without a conversation id take no part.
    """
    return turns.where(F.col(conv).isNotNull()).groupBy(F.col(conv).alias("conv")).agg(F.array_sort(F.collect_set(F.struct(
        F.coalesce(F.col(turn).cast("bigint"), F.lit(-1)).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")))).alias("turns"))


def neighbour_pairs(convs: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, chosen, rejected): even conversation ids with the odd id that follows.

    A conversation whose partner is missing keeps its row, with NULL on the other side.
    """
    half = convs.withColumn("pair_id", F.shiftright(F.col("conv").cast("bigint"), 1))  # halved downwards, exact at any size
    side = lambda odd: half.where(F.pmod("conv", F.lit(2)) == odd)
    chosen = side(0).select("pair_id", F.col("conv").alias("chosen_id"), F.col("turns").alias("chosen"))
    rejected = side(1).select("pair_id", F.col("conv").alias("rejected_id"), F.col("turns").alias("rejected"))
    return chosen.join(rejected, "pair_id", "full")


def _header(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(t["text"], F.lit("<|end|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _mask(turns: Column, trained: str) -> Column:
    """(n, train) runs over the rendered text: the bodies of the trained role count towards the loss."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.char_length(_header(t)).cast("bigint").alias("n"), F.lit(False).alias("train")),
        F.struct(F.char_length(_body(t)).cast("bigint").alias("n"), (t["role"] == trained).alias("train")))))


def format_pairs(pairs: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per pair: n_common, prompt, both completions and their masks.

    ``prompt`` renders the longest common prefix of whole turns (same role and text) once; each
    completion renders the turns after it. Equal conversations give two empty completions; a
    missing side has no turns, so nothing is common. Masks cover their completion exactly.
    """
    none = F.array().cast(pairs.schema["chosen"].dataType)
    sides = pairs.withColumns({"chosen": F.coalesce("chosen", none), "rejected": F.coalesce("rejected", none)})
    same = F.zip_with("chosen", "rejected", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    first_off = F.array_position(same, False)
    n = F.when(first_off > 0, first_off - 1).otherwise(F.size(same)).cast("int")
    cut = sides.withColumn("n_common", n).withColumns({
        "__prompt": F.slice("chosen", F.lit(1), F.col("n_common")),
        "__chosen": F.slice("chosen", F.col("n_common") + 1, F.greatest(F.size("chosen") - F.col("n_common"), F.lit(0))),
        "__rejected": F.slice("rejected", F.col("n_common") + 1, F.greatest(F.size("rejected") - F.col("n_common"), F.lit(0)))})
    return cut.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n_common").cast("bigint").alias("n_common"),
        _render(F.col("__prompt")).alias("prompt"), _render(F.col("__chosen")).alias("chosen"), _render(F.col("__rejected")).alias("rejected"),
        _mask(F.col("__chosen"), trained).alias("chosen_mask"), _mask(F.col("__rejected"), trained).alias("rejected_mask"))


def mask_text(mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["n"].cast("string"), m["train"].cast("int").cast("string"))), ",")
