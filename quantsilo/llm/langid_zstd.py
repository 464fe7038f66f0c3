"""Language identification by compression.

Each language gets a zstandard compressor whose dictionary is raw text of that language.  A text
belongs to the language whose compressor makes it smallest; where two are too close to call even
for a slower compressor, the text is rejected.  Long texts are compressed in blocks, each on its
own against the dictionaries, and the sizes added up: a dictionary saves a bounded number of bytes
on one piece, so the margin of a whole text would shrink with its length.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm.common import map_rows, small_batches

#: Bound of the training sample: so many documents of each language at most, whole ones, in the order
#: of a hash of the id, while they fit into DICT_BYTES bytes.
TRAIN_DOCS = 256
DICT_BYTES = 1 << 16
LEVEL = 6
#: Where the best two differ by less than MIN_GAP bytes, sizes are added up over a slower level and over so many
#: parts of the dictionary as well: sizes are whole bytes, and short texts often tie.
SLOW_LEVEL = 12
PARTS = 8
MIN_GAP = 1
#: Bytes of letters that are compressed at once, about.
BLOCK = 1 << 14
#: A text is rejected when the best language saves less than this part of the runner-up's size.
MIN_MARGIN = 0.005


def blocks(raw: bytes) -> list[bytes]:
    """Consecutive pieces of the whole text, of equal length but for a byte."""
    n = max(1, (len(raw) + BLOCK // 2) // BLOCK)
    return [raw[len(raw) * k // n:len(raw) * (k + 1) // n] for k in range(n)]


def letters(text: Column) -> Column:
    """Lower-cased words of letters, joined by single spaces, with one at either end."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}]+", " "))


class Compressors:
    """A classifier made of raw-content dictionaries; it pickles as those and is set up on first use."""

    def __init__(self, samples: dict[str, bytes], min_margin: float = MIN_MARGIN):
        #: in the order that settles ties
        self.samples, self.min_margin, self._ready = samples, min_margin, {}
        #: documents in each dictionary, where ``train`` has made it
        self.used: dict[str, int] = {}

    def __getstate__(self):
        return {"samples": self.samples, "min_margin": self.min_margin, "used": self.used, "_ready": {}}

    def _sizes(self, texts: list[bytes], level: int, part: int | None = None) -> list[int]:
        """Compressed size of all blocks for each language, with its dictionary or a part of it."""
        if (level, part) not in self._ready:
            made = []
            for raw in self.samples.values():
                if part is not None:
                    step = -(-len(raw) // PARTS)
                    raw = raw[part * step:(part + 1) * step]
                kind = dict(level=level, write_content_size=False, write_checksum=False, write_dict_id=False)
                if raw:
                    d = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                    d.precompute_compress(level=level)
                    kind["dict_data"] = d
                made.append(zstd.ZstdCompressor(**kind))
            self._ready[level, part] = made
        return [sum(len(c.compress(t)) for t in texts) for c in self._ready[level, part]]

    def classify(self, text: str) -> tuple[str, float, bool]:
        """(language, confidence, rejected) of a text that ``letters`` has prepared."""
        if not text or not self.samples:
            return "und", 0.0, True
        raw = f" {text} ".encode()
        names = list(self.samples)
        pieces = blocks(raw)
        sizes = self._sizes(pieces, LEVEL)
        rank = sorted(range(len(names)), key=sizes.__getitem__)
        if len(names) == 1:
            return names[0], 1.0, False
        if sizes[rank[1]] - sizes[rank[0]] < MIN_GAP:
            more = [self._sizes(pieces, SLOW_LEVEL), *(self._sizes(pieces, LEVEL, k) for k in range(PARTS))]
            sizes = [sum(x) for x in zip(sizes, *more)]
            rank = sorted(range(len(names)), key=sizes.__getitem__)
        margin = 1 - sizes[rank[0]] / sizes[rank[1]]
        return names[rank[0]], margin, margin < self.min_margin


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS, dict_bytes: int = DICT_BYTES, min_margin: float = MIN_MARGIN) -> Compressors:
    """Dictionaries from the rows where ``learn`` holds and text and language are known.

    The documents of a language are chosen by the order of a hash of the id, among those whose letters fit
    into a dictionary: a partition passes on its own ``train_docs`` smallest of each language, so a
    frequent language is no burden for one task.  In that order they are joined whole, as long as all
    fit into ``dict_bytes``, which for each language bounds what the driver gets.  Rows that
    repeat an id and a language stand in once.  Null and empty texts teach nothing; without rows to learn
    from there are no languages.  Ties in size go to the language with more training rows, then by name.
    ``Compressors.used`` tells how many documents each dictionary holds.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), letters(F.col(text_col)).alias("t"))
    keys = rows.select("id", "lang", F.xxhash64("id").alias("h"), (F.octet_length("t") + 3).alias("n"),
                       F.xxhash64("t").alias("d"))          # with the separator
    first = Window.partitionBy("lang").orderBy("h", "id", "n", "d")
    few = keys.where((F.col("n") > 3) & (F.col("n") <= dict_bytes)).withColumn("k", F.row_number().over(first)).where(
        F.col("k") <= train_docs)
    fits = F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= dict_bytes
    picked = few.withColumn("fits", fits).where("fits").select("id", "lang", "d").distinct()
    sizes = dict(rows.groupBy("lang").count().collect())
    got = (rows.withColumn("d", F.xxhash64("t")).join(F.broadcast(picked), ["id", "lang", "d"], "left_semi")
           .select("lang", F.xxhash64("id").alias("h"), "t").distinct().collect())
    text: dict[str, list[str]] = {}
    for r in sorted(got):
        text.setdefault(r["lang"], []).append(r["t"])
    order = sorted(text, key=lambda x: (-sizes[x], x))
    model = Compressors({x: " \n ".join(text[x]).encode() for x in order}, min_margin)
    model.used = {x: len(text[x]) for x in order}
    return model


def classify(docs: DataFrame, model: Compressors, keep: tuple[str, ...] = (), text_col: str = "text",
             prefix: str = "") -> DataFrame:
    """Columns ``keep`` of every row with lang_pred, score, rejected of its whole text.

    A text that is null or has no letter is ``und`` with score 0 and rejected, and so is every text
    when there is nothing to learn from.  Otherwise lang_pred is a learned language, score the part
    of the runner-up's size that the winner saves, and rejected tells that the margin was too narrow.
    One narrow pass, no shuffle; repeated rows get the same answer.
    """
    small_batches(docs.sparkSession)

    def decide(texts):
        out = [model.classify(t) for t in texts.to_pylist()]
        return (pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
                pa.array([x[2] for x in out], pa.bool_()))

    return map_rows(docs, keep, letters(F.col(text_col)), decide, [
        (f"{prefix}lang_pred", "string"), (f"{prefix}score", "double"), (f"{prefix}rejected", "boolean")])
