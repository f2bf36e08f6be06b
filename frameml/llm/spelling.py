"""Spelling variants of a vocabulary by pivotal grams.

Two words at one edit are found without comparing all words.  Bigrams are
ordered by rarity.  A word's prefix are its three rarest bigrams (with all
places of the third); its pivots are the two disjoint ones of them that the
fewest words hold, chosen by dynamic programming over the places.  One edit spoils at
most one pivot, and of two near words the one whose prefix ends earlier in the
order has an unspoilt pivot inside the other's prefix: pivots look up prefixes.

The edit lies either after the first pivot, which then keeps its place and all
before it, or before the second, which keeps its distance from the end and all after
it.  The rest of the word falls into halves of which the edit spares one.  So a
look-up asks for the gram's place, the text on its sound side and one half of
the rest; buckets stay small even where a gram is frequent.  The places
allowed are the position limits of the method.  What shares a key is verified
by its edit distance inside the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.llm.hashing import BASE, BASE_INVERSE, mix, powers
from frameml.plans.lineage import cut_lineage
from frameml.sources.tables import read_table

# Grams are numbered by a hash of this many bits, so the table of their counts has a fixed size.
GRAM_BITS = 16
# One edit spoils q = 2 bigrams; the prefix has q + 1 of them, of which two disjoint ones are pivots.
PREFIX, PIVOTS = 3, 2
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are set between marks, so that short ones have enough grams too.
LEAD, TRAIL = "\x02\x02", "\x02"


def _spread(words) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the marked words in one array, and where each begins (one more for the end)."""
    marked = [LEAD + w + TRAIL for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return points, np.concatenate(([0], np.cumsum(list(map(len, marked)), dtype=np.int64)))


def _grams(points: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, number) of every bigram."""
    sizes = np.diff(begin) - 1
    word = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = begin[word] + place
    number = mix(points[at] * BASE + points[at + 1]) >> np.uint64(64 - GRAM_BITS)
    return word, place, number.astype(np.int64)


def _count_grams(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows:
            word, _, number = _grams(*_spread(batch.column("word").to_pylist()))
            # A word counts once for each of its grams.
            counts = np.bincount(np.unique(word * (1 << GRAM_BITS) + number) & ((1 << GRAM_BITS) - 1), minlength=1 << GRAM_BITS)
            gram = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(counts[gram])], names=["gram", "n"])


def pivots(place: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """For rows of grams in rising place, the columns of the two disjoint grams of least total cost."""
    n, m = place.shape
    best, came = cost.astype(np.float64), []
    for _ in range(PIVOTS - 1):
        step, back = np.full((n, m), np.inf), np.zeros((n, m), np.int64)
        for i in range(1, m):
            earlier = np.where(place[:, :i] <= place[:, i:i + 1] - 2, best[:, :i], np.inf)
            back[:, i] = np.argmin(earlier, axis=1)
            step[:, i] = cost[:, i] + earlier[np.arange(n), back[:, i]]
        best = step
        came.append(back)
    out = [np.argmin(best, axis=1)]
    for back in reversed(came):
        out.append(back[np.arange(n), out[-1]])
    return np.stack(out[::-1], axis=1)


class Keys:
    """The look-up keys of one batch of words; ``counts`` says how many words hold each gram."""

    def __init__(self, words, counts: np.ndarray) -> None:
        points, self.begin = _spread(words)
        self.size = np.diff(self.begin)
        self.down = powers(BASE_INVERSE, len(points))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(points + BASE) * powers(BASE, len(points))[:-1])))
        word, place, gram = _grams(points, self.begin)
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
        rank = rank[gram]
        order = np.lexsort((place, rank, word))
        first = self.begin[:-1] - np.arange(len(self.size))
        self.last = rank[order[first + PREFIX - 1]]
        chosen = np.sort(order[first[:, None] + np.arange(PREFIX)], axis=1)
        pick = np.take_along_axis(chosen, pivots(place[chosen], counts[gram[chosen]]), axis=1)
        self.left, self.right = place[pick[:, 0]], place[pick[:, 1]]
        inside = rank <= self.last[word]
        self.word, self.place = word[inside], place[inside]

    def _digest(self, word: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        a, b = self.begin[word] + start, self.begin[word] + stop
        return mix((self.sums[b] - self.sums[a]) * self.down[a])

    def _key(self, tag: int, word, sound: tuple, other: tuple, at, part) -> np.ndarray:
        place = mix(at.astype(np.uint64) * np.uint64(1 << 32) + part.astype(np.uint64) * np.uint64(4) + np.uint64(tag))
        return mix(self._digest(word, *sound) + mix(self._digest(word, *other) ^ place))

    def _after(self, word, place, half, part) -> np.ndarray:
        """The edit lies after the gram: what is before it and the first or last ``part`` of the rest are sound."""
        end = self.size[word]
        other = (place + 2, place + 2 + part) if half == 0 else (end - part, end)
        return self._key(half, word, (np.zeros_like(place), place + 2), other, place, part)

    def _before(self, word, place, half, part) -> np.ndarray:
        """The edit lies before the gram."""
        end = self.size[word]
        other = (np.zeros_like(place), part) if half == 0 else (place - part, place)
        return self._key(2 + half, word, (place, end), other, end - place, part)

    def look_ups(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key): four for each word."""
        word = np.arange(len(self.size))
        out = []
        for side, place, rest in ((self._after, self.left, self.size - self.left - 2), (self._before, self.right, self.right)):
            out += [side(word, place, 0, rest // 2), side(word, place, 1, rest - rest // 2)]
        return np.tile(word, len(out)), np.concatenate(out)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key): for each place of the prefix, each side and each half, for what a word
        of the same size or of one more or less would ask."""
        words, keys = [], []
        for side, rest in ((self._after, self.size[self.word] - self.place - 2), (self._before, self.place)):
            for half in (0, 1):
                asked = [np.maximum(rest + d, 0) for d in (-1, 0, 1)]
                parts = [r // 2 if half == 0 else r - r // 2 for r in asked]
                for k, part in enumerate(parts):
                    new = part <= rest
                    for earlier in parts[:k]:
                        new &= part != earlier
                    words.append(self.word[new])
                    keys.append(side(self.word[new], self.place[new], half, part[new]))
        return np.concatenate(words), np.concatenate(keys)


def _map_keys(counts: np.ndarray, asking: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            found = Keys(batch.column("word").to_pylist(), counts)
            word, key = found.look_ups() if asking else found.entries()
            at = pa.array(word)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("word").take(at), batch.column("n").take(at),
                 pa.array(found.last[word].astype(np.int32))], names=["key", "word", "n", "last"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """All pairs (a, b, a_n, b_n), a < b, of the distinct words of (word, n) that differ by exactly
    one inserted, deleted or replaced code point."""
    counted = words.select("word").mapInArrow(_count_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << GRAM_BITS, np.int64)
    # One line for each gram number at most.
    for gram, n in counted.collect():
        counts[gram] = n
    kind = "key long, word string, n long, last int"
    ask = words.mapInArrow(_map_keys(counts, True), kind).select("key", *(F.col(c).alias(f"q_{c}") for c in ("word", "n", "last")))
    held = words.mapInArrow(_map_keys(counts, False), kind)
    near = ask.join(held, [ask["key"] == held["key"], F.col("q_last") <= F.col("last"),
                           F.abs(F.length("q_word") - F.length("word")) <= 1,
                           F.levenshtein("q_word", "word", 1) == 1])
    first = F.col("q_word") < F.col("word")

    def ends(low: Column, high: Column) -> Column:
        return F.when(first, low).otherwise(high)

    return near.select(ends(F.col("q_word"), F.col("word")).alias("a"), ends(F.col("word"), F.col("q_word")).alias("b"),
                       ends(F.col("q_n"), F.col("n")).alias("a_n"), ends(F.col("n"), F.col("q_n")).alias("b_n")).distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of every chain, by joining chains to chains."""
    links = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        links = step.select("word", "root")
        if step.where("next is not null").isEmpty():
            return links


def spelling_variants(words: DataFrame, word_col: str = "word", count_col: str = "n", ratio: int = 2) -> DataFrame:
    """One row per distinct word: (word, form, root, n, n_near, form_n).

    A word's form is its near word (one edit away) of the largest count, the smallest in
    code-point order among equals, if that count is at least ``ratio`` (> 1) times its own;
    else null.  Its root is where following forms ends, itself without a form.  The
    counts of repeated words are added, a null count is 0; null and empty words
    are left out, other columns ignored.  An empty table gives an empty result.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1, else forms could go in a circle")
    words = cut_lineage(words.select(F.col(word_col).alias("word"), F.col(count_col).cast("long").alias("n"))
                        .where("word <> ''").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    pairs = near_words(words)
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("n")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("n"))))
    best = (pairs.select(both.alias("p")).select("p.*").groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("best")))
    formed = F.col("best.n") * -1 >= F.col("n") * ratio
    known = cut_lineage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.n")).alias("form_n")))
    roots = _roots(known.where("form is not null"))
    return (known.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def text_runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run): maximal runs of Latin letters of at least ``least`` code points, A-Z lower-cased."""
    run = F.col("run")
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN + f"{{{least},}}+"), F.lit(0)))
    small = F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run)
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("run")).select("doc_id", small.alias("run"))


def misspelt(runs: DataFrame, every: int = 97) -> DataFrame:
    """(word) of (doc_id, run): runs whose checksum with their document is divisible by ``every`` lose
    one code point.  A run without a document keeps all."""
    run, h = F.col("run"), F.col("h")
    at = h % F.length(run)
    cut = F.concat(F.substring(run, F.lit(1), at.cast("int")), F.substring(run, (at + 2).cast("int"), F.length(run)))
    hashed = runs.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), run)))
    return hashed.select(F.when(h % every == 0, cut).otherwise(run).alias("word"))


def spelling_report(docs: DataFrame, least: int = 5, occurrences: int = 3) -> DataFrame:
    """Variants among the words of whole texts of at least ``least`` code points and ``occurrences`` places.
    Null and empty texts have no word; repeated rows count again."""
    words = misspelt(text_runs(docs, least)).where(F.length("word") >= least)
    counted = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)
    return spelling_variants(counted)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_report(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive crc as (
  select list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)),
         lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t
), runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') as run from documents)
  where length(run) >= 5 group by all
), hashed as (
  select run, n, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
         list_transform(string_split(doc_id || ':' || run, ''), lambda x: unicode(x)::bigint),
         lambda c: case when c < 128 then [c] else [192 + (c >> 6), 128 + (c & 63)] end))),
         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h from runs, crc
), w as (
  select word, sum(n)::bigint as n from (
    select case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
           else run end as word, n from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3
), less as (
  select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as d from (select word, unnest(range(1, length(word) + 1)) as i from w)
), near as (
  select a.word, b.word as other from less a join less b on a.i = b.i and a.d = b.d and a.word <> b.word
  union select less.word, w.word from less join w on less.d = w.word
  union select w.word, less.word from less join w on less.d = w.word
), best as (
  select near.word, count(*) as n_near, max(b.n) as top from near join w b on near.other = b.word group by near.word
), form as (
  select w.word, w.n, best.n_near, best.top, min(near.other) as form
  from w join best on w.word = best.word join near on near.word = w.word join w b on near.other = b.word and b.n = best.top
  where best.top >= 2 * w.n group by all
), chain as (
  select word, word as root, 0 as step from w
  union all select chain.word, form.form, step + 1 from chain join form on chain.root = form.word
)
select w.word, form.form, root, w.n, coalesce(best.n_near, 0)::bigint as n_near, form.top as form_n
from w left join best on w.word = best.word left join form on w.word = form.word
join (select word, max_by(root, step) as root from chain group by word) r on r.word = w.word
"""

QUERIES = {"op12_spelling": op12_spelling}
SQL = {"op12_spelling": ORACLE}
