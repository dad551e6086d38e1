"""Document fingerprints by consistent weighted sampling.

A text is its words with their counts as weights. For each of ``SAMPLES`` samples a
word w with weight S draws, from hashes of the word and the sample's number alone,
r and c from Gamma(2, 1) and b from the unit interval, and takes part with

    t = floor(ln S / r + b),    ln a = ln c - r (t - b + 1).

The least ln a of all words is the sample. Two texts have the same least value with
the probability of their generalised Jaccard similarity, the sum of the lesser
weights over the sum of the greater ones. Since ln a tells word and t apart, the
value alone is kept, as 32 bits of its hash.

All of it is DataFrame work. Documents are dealt out by id once; words, counts and
samples of a document are worked out where it lies.
"""

from functools import reduce
from operator import add

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE_CLASS, whole_text, written

SAMPLES = 32  # the standard error of a likeness is 0.088 at most
TOGETHER = 4  # samples worked out in one row: keeps generated code small
HEX = 8  # digits per sample
# What stands for a NULL id, which comes before all others.
NO_ID = -(2**63)


def _uniform(bits, shift, width):
    """A number strictly inside the unit interval out of ``width`` bits of a hash."""
    cut = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (cut + F.lit(0.5)) * F.lit(2.0**-width)


def _sample(word, number, weights):
    """ln a of one word and sample for each weight; NULL for weights that are NULL."""
    first = F.xxhash64(word, number)
    second = F.xxhash64(first, number)
    r = -F.log(_uniform(first, 38, 26) * _uniform(first, 12, 26))
    c = -F.log(_uniform(second, 38, 26) * _uniform(second, 12, 26))
    b = _uniform(F.shiftleft(first, 12).bitwiseOR(second.bitwiseAND(F.lit(4095))), 0, 24)
    return [F.log(c) - r * (F.floor(F.log(w) / r + b) - b + 1) for w in weights]


def _words(rows, keys, texts):
    """Distinct words, hashed, with their count in each of some text columns.

    Figures ride along as words of a kind of their own: kind 0 is a word, kind i
    the figure i - 1.
    """
    texts, figures = texts
    parts = [
        F.struct(
            F.lit(0).alias("kind"),
            F.col(name).alias("text"),
            *[F.lit(int(i == j)).cast("long").alias(f"n{j}") for j in range(len(texts))],
        )
        for i, name in enumerate(texts)
    ]
    parts += [
        F.struct(
            F.lit(i).alias("kind"),
            F.lit("-").alias("text"),
            F.col(name).cast("long").alias("n0"),
            *[F.lit(0).cast("long").alias(f"n{j}") for j in range(1, len(texts))],
        )
        for i, name in enumerate(figures, 1)
    ]
    counts = [f"n{j}" for j in range(len(texts))]
    spread = rows.select(*keys, F.explode(F.array(*parts)).alias("p")).select(
        *keys,
        "p.kind",
        *[f"p.{n}" for n in counts],
        F.explode(F.split("p.text", SPACE_CLASS + "+")).alias("word"),
    )
    hashed = spread.where("word != ''").select(
        *keys, "kind", *counts, F.xxhash64("word").alias("word")
    )
    return hashed.groupBy(*keys, "kind", "word").agg(*[F.sum(n).alias(n) for n in counts])


def _signatures(rows, keys, texts, figures, samples):
    """Per row the hex signature of each text, and the figures."""
    words = _words(rows, keys, (texts, figures))
    chunks = F.sequence(F.lit(0), F.lit(samples // TOGETHER - 1))
    spread = words.select("*", F.explode(chunks).alias("chunk"))
    # The first figure stands in every chunk, so texts without words have all of them.
    spread = spread.where("kind <= 1 OR chunk = 0")
    aggregates = []
    counted = [F.col(f"n{j}") for j in range(len(texts))]
    weights = [F.when((F.col("kind") == 0) & (n > 0), n) for n in counted]
    for k in range(TOGETHER):
        number = F.col("chunk") * TOGETHER + k
        for j, value in enumerate(_sample(F.col("word"), number, weights)):
            aggregates.append(F.min(value).alias(f"s{j}_{k}"))
    for i, name in enumerate(figures, 1):
        aggregates.append(F.max(F.when(F.col("kind") == i, F.col("n0"))).alias(name))
    chunked = spread.groupBy(*keys, "chunk").agg(*aggregates)

    def spelled(j):
        parts = []
        for k in range(TOGETHER):
            bits = F.xxhash64(f"s{j}_{k}").bitwiseAND(F.lit(0xFFFFFFFF))
            digits = F.lower(F.lpad(F.hex(bits), HEX, "0"))
            # Texts without a word have no sample.
            parts.append(F.when(F.col(f"s{j}_{k}").isNull(), "0" * HEX).otherwise(digits))
        return F.concat(*parts)

    pieces = chunked.select(
        *keys,
        "chunk",
        *figures,
        *[spelled(j).alias(name) for j, name in enumerate(texts)],
    )
    whole = pieces.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("chunk", *texts))).alias("parts"),
        *[F.max(name).alias(name) for name in figures],
    )
    return whole.select(
        *keys, *figures, *[F.array_join(F.col(f"parts.{name}"), "").alias(name) for name in texts]
    )


def likeness(a, b, samples=SAMPLES):
    """The share of equal samples of two signature columns: an estimate of similarity."""

    def part(column, i):
        return F.substring(column, HEX * i + 1, HEX)

    equal = [(part(a, i) == part(b, i)).cast("int") for i in range(samples)]
    return reduce(add, equal) / F.lit(float(samples))


def _partitions(spark):
    # Twice the shuffle's number: a document meets its words, edited and plain, here.
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _neighbours(rows):
    """Per id the next and the previous one, around the end, and the latter's longest text."""
    ids = written(rows.groupBy("key").agg(F.max(F.length("text")).alias("n")), "ids")
    ranged = ids.repartitionByRange(_partitions(ids.sparkSession), "key").withColumn(
        "part", F.spark_partition_id()
    )
    ranged = written(ranged, "ids")
    inside = Window.partitionBy("part").orderBy("key")
    # One row per part, so this window is over a few rows.
    edges = ranged.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("n", "key").alias("last_n")
    )
    across = Window.orderBy("part")
    every = Window.partitionBy()
    edges = edges.select(
        "part",
        F.coalesce(F.lead("first").over(across), F.min("first").over(every)).alias("after"),
        F.coalesce(F.lag("last").over(across), F.max("last").over(every)).alias("before"),
        F.coalesce(F.lag("last_n").over(across), F.max_by("last_n", "last").over(every)).alias(
            "before_n"
        ),
    )
    return ranged.select(
        "part",
        "key",
        F.lead("key").over(inside).alias("next"),
        F.lag("key").over(inside).alias("previous"),
        F.lag("n").over(inside).alias("previous_n"),
    ).join(F.broadcast(edges), "part").select(
        "key",
        F.coalesce("next", "after").alias("next"),
        F.coalesce("previous", "before").alias("previous"),
        F.coalesce("previous_n", "before_n").alias("previous_n"),
    )


def _keyed(docs, doc_id, text):
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("key"),
        whole_text(text).alias("text"),
    )


def fingerprints(docs, doc_id="doc_id", text="text", samples=SAMPLES):
    """``doc_id`` and ``fingerprint`` (hex digits) of every row of ``docs``.

    Equal texts have equal fingerprints; texts without a word have all zeros (NULL
    texts are among them). NULL ids and repeated rows keep a row each; an empty
    table gives none. Ids must be whole numbers (or spell them). Very long texts become
    rows of words and need no more memory than their own text. Other columns of ``docs``
    are not read, so their names cannot clash.
    """
    rows = _keyed(docs, doc_id, text).repartition(_partitions(docs.sparkSession), "key")
    rows = rows.withColumn("copy", _copy()).withColumn("one", F.lit(1))
    found = _signatures(rows, ["key", "copy"], ["text"], ["one"], samples)
    return found.select(_id(), F.col("text").alias("fingerprint"))


def _id():
    return F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")


def _copy():
    """Tells rows of one id apart."""
    return F.row_number().over(Window.partitionBy("key").orderBy("text"))


def edit_report(docs, doc_id="doc_id", text="text", samples=SAMPLES):
    """Fingerprints of all texts and of their edited texts, and how like they are.

    The edited text has its last quarter of code points replaced by the first as many
    of the next document (or all it has), by ascending id, around the end; a single
    document is next to itself. Per row: ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    NULL texts are empty; NULL ids come first. Rows that share an id all have the
    same next document: the least text of the next id. An empty table gives no row.
    Ids, long texts and clashing names: as in :func:`fingerprints`.
    """
    spark = docs.sparkSession
    rows = _keyed(docs, doc_id, text)
    neighbours = written(_neighbours(rows), "neighbours")
    # The same exchange serves the documents and the heads they lend to others.
    dealt = rows.repartition(_partitions(spark), "key").withColumn("copy", _copy())
    quarter = F.floor(F.col("previous_n") / 4).cast("int")
    heads = (
        dealt.where("copy = 1")
        .join(neighbours.select("key", "previous", "previous_n"), "key")
        .select(F.col("previous").alias("key"), F.substring("text", F.lit(1), quarter).alias("head"))
    )
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut)
    )
    both = dealt.join(heads, "key").select(
        "key", "copy", "text", edited.alias("edited"), n.alias("n_chars")
    )
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    words = [f"sha{i}" for i in range(8)]
    both = both.select(
        "*",
        *[
            F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(name)
            for i, name in enumerate(words)
        ],
    )
    found = _signatures(both, ["key", "copy"], ["text", "edited"], ["n_chars", *words], samples)
    sha = F.concat(*[F.lower(F.lpad(F.hex(name), 8, "0")) for name in words])
    prints = written(
        found.select(
            "key", "copy", "n_chars", sha.alias("edited_sha256"), "text", "edited"
        ),
        "fingerprints",
    )
    following = prints.where("copy = 1").select(
        F.col("key").alias("next"), F.col("text").alias("next_print")
    )
    return (
        prints.join(neighbours.select("key", "next"), "key")
        .join(following, "next")
        .select(
            _id(),
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            F.col("text").alias("fingerprint"),
            F.col("edited").alias("edited_fingerprint"),
            likeness("text", "edited", samples).alias("near_edited"),
            likeness("text", "next_print", samples).alias("near_next"),
        )
    )
