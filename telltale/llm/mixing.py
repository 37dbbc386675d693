"""Mixing sources to target weights along a low-discrepancy schedule.

The documents of a source are laid end to end in a shuffled order and cut into blocks of equally
many words; a source that is wanted more than once goes on from its start. The slots of
the mix are the points of a van der Corput sequence: a point falls into the share of a source, and
the slots of a source, in their order, take its blocks one by one, so any stretch of the mix holds the
sources close to their weights. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telltale.llm.ordering import block, join_blocks, numbered
from telltale.llm.tasks import only, stored, word_count

BLOCK_WORDS = 1024
# So many cells of the schedule are made from one row.
_CELLS = 4096


@dataclass(frozen=True)
class Mix:
    """A mix of sources.

    ``documents`` has ``row, doc_id, source, size, source_size, target`` per document,
    ``slots`` has ``slot, source_no, block`` in the order of the mix, and ``pieces`` what a
    slot holds: ``slot, source_no, block, row, doc_id, from_word, to_word, epoch``, with words counted from
    0 in the document.
    """

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """Documents with ``taken``, the words of them in the mix, repeats counted."""
        n = F.sum(F.col("to_word") - F.col("from_word"))
        found = self.pieces.groupBy("row").agg(n.alias("taken"))
        return self.documents.join(found, "row", "left").fillna({"taken": 0})


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
) -> Mix:
    """Mix the sources of ``docs(doc_id, source, text)``.

    Sources in the order of their code points, NULL last, weigh ``weights`` over and
    over. Together they get ``share`` of all words, none more than ``most`` times its own;
    what is beyond is shared again by weight. Each takes its target to the word, so every document goes into the mix
    ``most`` times at most. A document without words, or a NULL text, takes no part.
    Repeated rows and rows with one id or none are documents of their own. The order
    within a source follows a digest of the id, so reruns agree.
    """
    sizes = only(docs, "doc_id", "source", "text").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), *_source_key()
    )
    shuffled = F.xxhash64("doc_id", F.lit("order of the mix"))
    keys = [F.col("absent"), F.col("name"), shuffled, F.col("doc_id"), F.col("size")]
    placed = stored(numbered(sizes, keys, "documents", into="row", sums=("size",)), "documents-at")
    sources = stored(_targets(placed, weights, share, most, block_words), "sources")
    known = sources.select(
        "absent", "name", "source_no", "source_size", "target", "words", "before_words"
    )
    full = stored(join_blocks(placed, known, ["absent", "name"], [block("row")]), "documents-targets")
    slots = stored(_slots(sources), "slots")
    pieces = _pieces(full, most, block_words)
    pieces = slots.join(pieces, ["source_no", "block"]).select(
        "slot", "source_no", "block", "row", "doc_id", "from_word", "to_word", "epoch"
    )
    documents = full.select("row", "doc_id", "source", "size", "source_size", "target")
    return Mix(documents, slots, pieces)


def _source_key() -> list[Column]:
    # No NULL, so that it can be joined; false sorts before true.
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return [F.col("source").isNull().alias("absent"), name.alias("name")]


def _targets(
    placed: DataFrame, weights: Sequence[int], share: float, most: int, block_words: int
) -> DataFrame:
    """One row per source: its target, the words it gives and its cells of the schedule.

    A level of words per weight is sought at which all is shared out. Sources in
    the order of the level at which they are full: those before one are full, the
    rest shares what they leave, and the first source that this does not fill gives
    the level for all after it.
    """
    sources = placed.groupBy("absent", "name").agg(
        F.sum("size").alias("source_size"),
        F.min(F.col("run_size") - F.col("size")).alias("before_words"),
    )
    sources = numbered(sources, [F.col("absent"), F.col("name")], "sources", into="source_no")
    turn = (F.col("source_no") % len(weights)).cast("int") + 1
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn)
    sources = sources.withColumns({"weight": weight, "bound": F.col("source_size") * most})
    full_at = F.col("bound") / F.col("weight")
    ranked = stored(
        numbered(sources, [full_at, F.col("source_no")], "fill", into="rank", sums=("bound", "weight")),
        "sources-filled",
    )
    whole = ranked.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("weight"), F.lit(0)).alias("weights"),
    ).first()
    left = F.lit(share * whole["words"]) - (F.col("run_bound") - F.col("bound"))
    among = F.lit(whole["weights"]) - (F.col("run_weight") - F.col("weight"))
    level = left / among
    first = ranked.where(full_at > level).agg(F.min(F.struct("rank", level.alias("level"))).alias("s"))
    found = first.select("s.*").first()
    bound = F.col("bound").cast("double")
    if found["rank"] is None:
        target = bound
    else:
        shared = F.col("weight") * F.lit(float(found["level"]))
        target = F.when(F.col("rank") < found["rank"], bound).otherwise(shared)
    ranked = ranked.withColumn("target", target)
    words = F.least(F.round("target").cast("bigint"), F.col("bound"))
    ranked = ranked.withColumn("words", words)
    n_blocks = F.ceil(F.col("words") / block_words).cast("bigint")
    cells = ranked.select(
        "absent", "name", "source_no", "source_size", "before_words", "target", "words",
        n_blocks.alias("n_blocks"),
    )
    return numbered(cells, [F.col("source_no")], "cells", sums=("n_blocks",))


def van_der_corput(cell: Column, bits: int) -> Column:
    """The binary digits of a number in reverse: the base-2 sequence times ``2 ** bits``."""
    found = F.lit(0).cast("bigint")
    for i in range(bits):
        bit = F.shiftright(cell, i).bitwiseAND(F.lit(1).cast("bigint"))
        found = found.bitwiseOR(F.shiftleft(bit, bits - 1 - i))
    return found


def _slots(sources: DataFrame) -> DataFrame:
    """``(slot, source_no, block)``: which block of which source comes when.

    The sources share the cells 0, 1, 2, ... in their order, as many each as they
    have blocks. With 2^m cells or fewer the first 2^m points of the sequence
    meet every cell once, and the point that meets a cell is found by turning its digits
    round again; points beyond the cells are no slots. Ranked by slot, the slots of a source take its blocks.
    """
    total = sources.agg(F.coalesce(F.sum("n_blocks"), F.lit(0))).first()[0]
    bits = max(1, (max(total, 1) - 1).bit_length())
    first = F.col("run_n_blocks") - F.col("n_blocks")
    spans = sources.where("n_blocks > 0").select("source_no", first.alias("first"), "n_blocks")
    lots = spans.select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_blocks") - 1) / _CELLS).cast("bigint"))).alias("lot")
    )
    low = F.col("lot") * _CELLS
    high = F.least(low + _CELLS, F.col("n_blocks")) - 1
    cells = lots.repartition("source_no", "lot").select(
        "source_no", "first", F.explode(F.sequence(F.col("first") + low, F.col("first") + high)).alias("cell")
    )
    points = cells.select("source_no", "first", van_der_corput(F.col("cell"), bits).alias("slot"))
    ranked = numbered(points, [F.col("source_no"), F.col("slot")], "slots")
    return ranked.select("slot", "source_no", (F.col("idx") - F.col("first")).alias("block"))


def _pieces(full: DataFrame, most: int, block_words: int) -> DataFrame:
    """What of which document lies in which block of its source."""
    laps = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(most)])).alias("epoch")
    start = F.col("run_size") - F.col("size") - F.col("before_words")
    laid = full.where("size > 0").select("row", "doc_id", "source_no", "size", "source_size", "words", start.alias("start"), laps)
    laid = laid.withColumn("low", F.col("epoch") * F.col("source_size") + F.col("start"))
    laid = laid.withColumn("high", F.least(F.col("low") + F.col("size"), F.col("words"))).where("low < high")

    def at(word: Column) -> Column:
        return F.floor(word / block_words).cast("bigint")

    cut = laid.select("*", F.explode(F.sequence(at(F.col("low")), at(F.col("high") - 1))).alias("block"))
    begin = F.greatest("low", F.col("block") * block_words)
    end = F.least(F.col("high"), (F.col("block") + 1) * block_words)
    return cut.select(
        "source_no", "block", "row", "doc_id", "epoch",
        (begin - F.col("low")).alias("from_word"), (end - F.col("low")).alias("to_word"),
    )
