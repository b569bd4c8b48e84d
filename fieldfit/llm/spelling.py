"""Spelling variants: words one edit apart, found by walking a trie as joins.

The vocabulary becomes a table of trie edges. Chains of letters without a branch are
one edge, so a level of the walk is a branching point or the end of a word, and long
words need no more levels than short ones. A state is (word, position, node, edits):
it stands at a node of the trie with the letters up to the position used up.

Two words one edit apart part at a node where the trie branches. States without an
edit are a word's own nodes; the first join takes each of them over the edges that
differ from the word's next letter, as a replaced, an additional or a missing letter.
From then on a state goes on only along the edge that has the word's next letters,
level by level, and a state that ends with its word at the end of another makes the
two neighbours.

An edit in the first half of a word leaves its second half alone, and the other way
round. So words walk one trie of the words and one of the reversed words, and in
each only from the node after the first half on, where branches are few: no node is
the meeting point of the whole vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldfit.llm.common import stored

LETTER = "[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
MISSPELT = 199  # of so many (document, word) pairs one loses a letter in the registered query
HELD_WORDS = 300_000
SPELT_OUT = 32  # longer prefixes are named by a 128-bit hash
BATCH = 50_000


def misspelt(word: str, place: int) -> str:
    """``word`` without one letter if MISSPELT divides ``place``."""
    if place % MISSPELT:
        return word
    at = place % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LEAST_LETTERS, count: int = LEAST_COUNT, plant: bool = False
) -> DataFrame:
    """(``word``, ``n``): words of at least ``letters`` letters and ``count`` occurrences.

    Words are maximal runs of LETTER, lower-cased in A-Z. With ``plant`` one in
    MISSPELT pairs of document and word, chosen by the CRC-32 of both, loses a letter;
    rows without a key lose none. NULL and empty texts have no words.

    A task adds up what it reads before anything is shuffled and holds HELD_WORDS
    different words at most.
    """
    find = re.compile(f"{LETTER}{{{letters},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for at in range(0, len(words), BATCH):
                part = words[at : at + BATCH]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], ["word", "n"])
            held.clear()

        for batch in batches:
            for doc, t in zip(batch["_key"], batch["_text"]):
                found = Counter(find((t.as_py() or "").encode().lower().decode()))  # bytes: only A-Z
                doc = doc.as_py()
                if plant and doc is not None:
                    begin = zlib.crc32(f"{doc}:".encode())
                    for word, n in found.items():
                        held[misspelt(word, zlib.crc32(word.encode(), begin))] += n
                else:
                    held.update(found)
                if len(held) > HELD_WORDS:
                    yield from out()
        yield from out()

    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    parts = rows.mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where((F.length("word") >= letters) & (F.col("n") >= count))


def word_name(word: str) -> str:
    """A short key of a word."""
    return word if len(word) <= SPELT_OUT else hashlib.sha256(word.encode()).hexdigest()


def node_names(word: str, first: int) -> Iterator[tuple[int, str]]:
    """(depth, name) of the prefixes of ``word`` from depth ``first`` on."""
    for depth in range(first, min(len(word), SPELT_OUT) + 1):
        yield depth, word[:depth]
    if len(word) > SPELT_OUT:
        state = xxhash.xxh3_128(word[:SPELT_OUT].encode())
        for depth in range(SPELT_OUT + 1, len(word) + 1):
            state.update(word[depth - 1].encode())
            if depth >= first:
                yield depth, "#" + state.hexdigest()  # no letter


def prefixes(words: DataFrame) -> DataFrame:
    """(``side``, ``word_name``, ``depth``, ``node``, ``next``): every word's nodes from its first half on.

    Side 0 reads words from the left, side 1 from the right. ``next`` is the letter
    after the node, empty at the end of the word.
    """
    names = ["side", "word_name", "depth", "node", "next"]
    types = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for word in batch["word"].to_pylist():
                name = word_name(word)
                for side, s in enumerate((word, word[::-1])):
                    mark = "><"[side]
                    for depth, node in node_names(s, len(s) // 2):
                        rows.append((side, name, depth, mark + node, s[depth : depth + 1]))
                        if len(rows) == BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return words.select("word").mapInArrow(run, "side int, word_name string, depth int, node string, next string")


def chains(words: DataFrame) -> DataFrame:
    """(``side``, ``s``, ``word``, ``stops``): each word, as its side reads it, with its nodes in the trie.

    Nodes are branching points, where words go on in several ways or one ends, and
    the end of the word itself.
    """
    paths = stored(prefixes(words), "trie-prefixes")
    branches = stored(
        paths.groupBy("node").agg(F.min("next").alias("low"), F.max("next").alias("high")).where("low <> high").select("node", (F.col("low") == "").alias("ends")),
        "trie-branches",
    )
    branch = branches.withColumnRenamed("node", "_node")
    stops = paths.join(branch, F.col("node") == F.col("_node"), "left").where("_node is not null or next = ''")
    stop = F.struct("depth", "node", F.col("_node").isNotNull().alias("branches"), F.coalesce("ends", F.lit(False)).alias("ends"))
    listed = stops.groupBy("side", "word_name").agg(F.sort_array(F.collect_list(stop)).alias("stops"))
    named = words.select("word", F.when(F.length("word") <= SPELT_OUT, F.col("word")).otherwise(F.sha2("word", 256)).alias("word_name"))
    s = F.when(F.col("side") == 1, F.reverse("word")).otherwise(F.col("word"))
    return stored(listed.join(named, "word_name").select("side", s.alias("s"), "word", "stops"), "trie-chains")


def trie_edges(walks: DataFrame) -> DataFrame:
    """(``node``, ``letter``, ``label``, ``child``, ``ending``): the trie; ``ending`` is the word that ends at the child."""
    steps = F.transform(
        F.sequence(F.lit(1), F.size("stops") - 1),
        lambda i: F.struct(F.get("stops", i - 1).alias("a"), F.get("stops", i).alias("b")),
    )
    each = walks.where(F.size("stops") > 1).select("s", "word", F.explode(steps).alias("e"))
    label = F.substring("s", F.col("e.a.depth") + 1, F.col("e.b.depth") - F.col("e.a.depth"))
    edges = each.select(
        F.col("e.a.node").alias("node"),
        label.alias("label"),
        F.col("e.b.node").alias("child"),
        F.when(F.col("e.b.depth") == F.length("s"), F.col("word")).alias("ending"),
    )
    grouped = edges.groupBy("node", F.substring("label", 1, 1).alias("letter"))
    # All rows of a group are the same edge; only the word that ends there knows it.
    return stored(grouped.agg(F.min("label").alias("label"), F.min("child").alias("child"), F.max("ending").alias("ending")), "trie-edges")


def from_place(s: str, position: str | Column, n: Column) -> Column:
    """``n`` letters of ``s`` after the first ``position``."""
    return F.substring(s, (F.col(position) if isinstance(position, str) else position) + 1, n)


def neighbours(words: DataFrame) -> DataFrame:
    """(``word``, ``near``): all ordered pairs of different ``word`` values one edit apart.

    An edit is one code point inserted, deleted or replaced. ``words`` has every word
    once; each has two code points or more.
    """
    walks = chains(words)
    edges = trie_edges(walks)
    one = F.lit(1)
    at_branch = walks.select("side", "s", F.explode("stops").alias("stop")).where("stop.branches").select("side", "s", F.col("stop.depth").alias("position"), "stop.node", "stop.ends")
    own = from_place("s", "position", one)
    # A letter of the word is missing in the neighbour.
    shorter = F.substring("s", F.lit(1), F.col("position"))
    missing = at_branch.where((own != "") & (from_place("s", F.col("position") + 1, one) != own)).select(
        "side", "s", (F.col("position") + 1).alias("position"), "node", F.when(F.col("ends"), F.when(F.col("side") == 1, F.reverse(shorter)).otherwise(shorter)).alias("ending")
    )
    # The neighbour has another letter, or one more.
    size, rest = F.length("label") - 1, F.expr("substring(label, 2)")
    more = F.when(from_place("s", "position", size) == rest, F.col("position") + size)
    other = F.when((own != "") & (from_place("s", F.col("position") + 1, size) == rest), F.col("position") + 1 + size)
    crossed = (
        at_branch.join(edges, "node")
        .where(F.col("letter") != own)
        .select("side", "s", F.explode(F.array_compact(F.array(more, other))).alias("position"), F.col("child").alias("node"), "ending")
    )
    states = stored(missing.unionByName(crossed), "trie-states")
    pairs = None
    while not states.isEmpty():
        done = states.where((F.col("position") == F.length("s")) & F.col("ending").isNotNull())
        found = done.select(F.when(F.col("side") == 1, F.reverse("s")).otherwise(F.col("s")).alias("word"), F.col("ending").alias("near"))
        pairs = found if pairs is None else pairs.unionByName(found)
        going = states.where(F.col("position") < F.length("s")).drop("ending").withColumn("letter", from_place("s", "position", one))
        states = stored(
            going.join(edges, ["node", "letter"])
            .where(from_place("s", "position", F.length("label")) == F.col("label"))
            .select("side", "s", (F.col("position") + F.length("label")).alias("position"), F.col("child").alias("node"), "ending"),
            "trie-states",
        )
    if pairs is None:
        return words.sparkSession.createDataFrame([], "word string, near string")
    return pairs.distinct()


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """One row per row of ``words`` (``word``, ``n``): word, form, root, n, n_near, form_n.

    * ``n_near`` is the number of words one edit apart. ``form`` is the most frequent
      of them (of equal ones the first in code-point order) if it has ``times`` the
      occurrences of the word or more, else NULL; ``form_n`` is its count.
    * ``root`` follows the forms to the last one; a word without a form is its own.
    * An empty table gives an empty result.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = stored(neighbours(words), "near-words")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    near = pairs.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))).alias("top")
    )
    judged = words.join(stored(near, "near-counts"), "word", "left")
    follows = -F.col("top.less") >= F.col("n") * times
    rows = stored(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(follows, F.col("top.word")).alias("form"), F.when(follows, -F.col("top.less")).alias("form_n")
        ),
        "forms",
    )
    # Every form is more frequent than its word by the factor, so chains are short.
    up = stored(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        next_ = up.withColumnsRenamed({"word": "_word", "root": "_root"})
        joined = stored(up.join(next_, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_word").isNotNull().alias("moved")), "roots")
        up = joined.drop("moved")
        if joined.where("moved").isEmpty():
            break
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of ``docs`` with planted misspellings."""
    return variants(word_counts(docs, plant=True))
