"""Toxicity scores from a learned lexicon, misspellings by Levenshtein automata, and the words around a hit.

Corpus pass: for every word of the labelled training texts, how many different toxic and clean texts hold it. Words, and
stems of four to eight letters, that occur almost only in toxic texts are the lexicon; it is kept as a trie. A word that
isn't in it is tried as a misspelling: a Levenshtein automaton of the word walks the trie and stops where no
continuation is within the allowed edits. A hit inside quotation marks, or near a word of saying and a quotation mark,
counts as quoted, not as abuse. A logistic model over open, misspelled and quoted hits gives the score.

Texts meet the lexicon by their different words: a batch is dictionary-encoded and each different word is looked up once.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskframe.llm import simhash
from riskframe.llm.common import stored
from riskframe.llm.tokens import kept, slices

#: A term needs so many different toxic texts, so large a share of toxic ones among all texts that hold it, and evidence: with
#: the labels dealt out by chance, so many words in all would be expected to pass (see ``learn_lexicon``).
MIN_TEXTS = 5
MIN_SHARE = 0.9
FALSE_TERMS = 1.0
STEMS = range(4, 9)
SPLIT = r"[^\p{L}\p{M}]+"
#: Labelled groups of near copies the logistic model is fitted on at most (the lexicon uses all of them).
FIT_ROWS = 20_000
#: Words left and right of a hit that decide whether it is quoted.
CONTEXT = 6
#: Words whose kinds a process remembers, and text bytes it works on at once.
KNOWN_WORDS = 400_000
CHUNK_BYTES = 3_000_000
#: Rows of some 64 bytes that are broadcast at most; beyond, texts and labels meet in a shuffle.
BROADCAST_ROWS = 1_000_000
#: Weights of log(1 + open, misspelled, quoted hits) and of the constant, towards which the fit is drawn.
PRIOR = np.array([3.0, 1.0, 0.5, -3.0])

# Characters written for letters, words of saying in the table's four languages, quotation marks.
LEET_SIGNS = "013457@$!"
LEET = str.maketrans(LEET_SIGNS, "oieastasi")
SAYING = {
    "said", "says", "say", "quote", "quoted", "quotes", "wrote", "called", "word", "words", "sagte", "sagt", "zitat",
    "schrieb", "wort", "dit", "disait", "citation", "mot", "dijo", "dice", "cita", "palabra",
}
QUOTES = "\"“”„«»‹›‘’"
#: What a misspelled hit counts in the code of a piece's hits.
MISSPELLED = 1 << 32
_HITS = (0, 1, MISSPELLED)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text is a multiple of 5; a null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bare(piece: str) -> str:
    """The word in a space-separated piece: lower case, without the signs at its ends."""
    word = piece.lower()
    return word if word.isalpha() else _EDGE.sub("", word)


def is_letter(c: str) -> bool:
    """A letter or a mark, as in ``SPLIT``."""
    return c.isalpha() or unicodedata.category(c)[0] == "M"


def runs(piece: str, extra: str = "") -> list[str]:
    """The runs of letters in a lower-cased piece, as the lexicon's words are cut; ``extra`` characters count as letters."""
    return "".join(c if is_letter(c) or c in extra else " " for c in piece.lower()).split()


def without_one(word: str) -> list[str]:
    """The word, and the word less each of its letters."""
    return [word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]


class Trie:
    """Terms with a mark for stems, which also match every longer word."""

    def __init__(self, words: list[str], stems: list[str], exact_only: frozenset[str] = frozenset()):
        self.name = uuid.uuid4().hex
        self.root: dict = {}
        self.exact_only = exact_only
        self.words, self.stems = set(words), set(stems)
        self.stem_lengths = sorted({len(s) for s in stems})
        # A word within one edit of a term equals it after at most one letter is taken from each: only such words walk the trie.
        self.shortened: set[str] = set()
        for term in words:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term
            if self.edits(term):
                self.shortened.update(without_one(term))

    def edits(self, term: str) -> int:
        return 1 if len(term) >= 5 and term not in self.exact_only else 0

    def exact(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in self.stem_lengths if len(word) >= n)

    def near(self, word: str) -> list[str]:
        """Terms within their allowed edits (insert, delete, replace, swap of neighbours), by automaton and trie."""
        n, found = len(word), []

        def walk(node, term_length, before, row, last):
            if "" in node and row[n] <= self.edits(node[""]):
                found.append(node[""])
            for c, child in node.items():
                if c == "":
                    continue
                new = [row[0] + 1]
                for i in range(1, n + 1):
                    cost = min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (word[i - 1] != c))
                    if before is not None and i > 1 and word[i - 1] == last and word[i - 2] == c:
                        cost = min(cost, before[i - 2] + 1)
                    new.append(cost)
                if min(new) <= 1 or min(row) <= 0:
                    walk(child, term_length + 1, row, new, c)

        walk(self.root, 0, None, list(range(n + 1)), "")
        return found

    def kind(self, piece: str) -> int:
        """0 no hit, 1 a term, 2 a misspelled term."""
        return self.kind_of(bare(piece))

    def kind_of(self, word: str) -> int:
        if len(word) < 3:
            return 0
        if self.exact(word):
            return 1
        if not word.isalpha():
            plain = word.translate(LEET)
            if plain != word and self.exact(plain):
                return 2
            word = plain
        return 2 if not self.shortened.isdisjoint(without_one(word)) and self.near(word) else 0

    def hits(self, piece: str) -> int:
        """Terms in a piece, and ``MISSPELLED`` times the misspelled ones: those of its joined words, else of it as a whole.

        Words are cut where the lexicon cuts them, but a character written for a letter first counts as one.
        """
        word = bare(piece)
        if word.isalpha():
            return _HITS[self.kind_of(word)]
        found = 0
        for part in runs(piece, LEET_SIGNS):
            kind = self.kind(part)
            found += _HITS[kind] if kind else sum(_HITS[self.kind(r)] for r in runs(part))
        return found or _HITS[self.kind_of(word)]


def is_quoted(pieces: list[str], at: int) -> bool:
    """Between an opening and a closing quotation mark within the window, or beside one mark and a word of saying."""
    left, right = pieces[max(0, at - CONTEXT) : at], pieces[at + 1 : at + 1 + CONTEXT]
    own = pieces[at]
    opened = own[:1] in QUOTES or any(p[:1] in QUOTES for p in left)
    closed = own[-1:] in QUOTES or any(p.rstrip(".,;:!?")[-1:] in QUOTES for p in [own, *right] if p)
    if opened and closed:
        return True
    return (opened or closed) and any(bare(p) in SAYING for p in left + right)


def features(texts: pa.Array, trie: Trie, known: dict[str, int]) -> np.ndarray:
    """(open, misspelled, quoted) hits of every whole text; null and empty texts have none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    flat = pc.replace_substring(pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " "), "\r", " ")
    lists = pc.split_pattern(flat, " ")
    coded = lists.flatten().dictionary_encode()
    if len(known) > KNOWN_WORDS:
        known.clear()
    kinds = np.empty(len(coded.dictionary), np.int64)
    for k, piece in enumerate(coded.dictionary.to_pylist()):
        kind = known.get(piece)
        if kind is None:
            kind = known[piece] = trie.hits(piece)
        kinds[k] = kind
    per_word = kinds[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
    ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
    hits = np.flatnonzero(per_word)
    out = np.zeros((len(texts), 3), np.int64)
    owner = np.searchsorted(ends, hits, side="right")
    words = lists.flatten()
    for hit, text in zip(hits.tolist(), owner.tolist()):
        first = int(ends[text - 1]) if text else 0
        a, b = max(first, hit - CONTEXT), min(int(ends[text]), hit + CONTEXT + 1)
        quoted = is_quoted(words.slice(a, b - a).to_pylist(), hit - a)
        misspelled, exact = divmod(int(per_word[hit]), MISSPELLED)
        out[text] += (0, 0, exact + misspelled) if quoted else (exact, misspelled, 0)
    return out


def _few(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if there are few enough: a doc_id may have one label and very many rows."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, group, alone) of all labelled training rows.

    Copies and near copies would make their own rare words look like terms. ``group`` names the texts that links of
    ``simhash.MAX_BITS`` or fewer differing fingerprint bits reach, copies included; a group counts once per label, with the
    words of all its texts. ``alone`` rows have no other row in their group.
    """
    marks = (
        labels.filter("toxic is not null and doc_id is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    marks = stored(marks, "labels")
    texts = docs.select("doc_id", "text").filter("doc_id is not null").join(_few(marks), "doc_id")
    prints = stored(simhash.with_fingerprints(texts), "label_prints")
    values = stored(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows")), "label_values")
    parts = simhash.components(simhash.linked(values)).withColumnRenamed("node", "fp")
    named = values.join(parts, "fp", "left").select("fp", "rows", F.coalesce("component", "fp").alias("group"))
    named = stored(named, "label_groups")
    sizes = named.groupBy("group").agg(F.sum("rows").alias("size"))
    of_value = named.join(sizes, "group").select("fp", "group", (F.col("size") == 1).alias("alone"))
    keys = stored(prints.select("doc_id", "text_hash", "fp").distinct().join(of_value, "fp").drop("fp"), "labelled")
    return texts.withColumn("text_hash", F.xxhash64("text")).join(_few(keys), ["doc_id", "text_hash"]).drop("text_hash")


def learn_lexicon(train: DataFrame) -> Trie:
    """Words and stems that occur almost only in toxic texts; all of ``train`` is counted, a group of near copies once.

    A word in n texts, a share s of them toxic, passes if n * KL(s, p) >= log(words / FALSE_TERMS), where p is the share of toxic
    texts and ``words`` the number of words in at least MIN_TEXTS texts: by Chernoff's bound chance alone then brings
    FALSE_TERMS of them at most. Toxic texts count no more often than the word has different neighbours in them. The support a term needs grows with the logarithm of the vocabulary, not with the corpus.
    A term whose neighbours by one edit are ordinary words (as clean texts show) is matched exactly only.
    """
    split = F.array_distinct(F.split(F.lower("text"), SPLIT))
    words = train.select("toxic", "group", "alone", F.explode(split).alias("word")).filter("length(word) between 3 and 40")
    once = words.filter("not alone").select("toxic", "group", "word").distinct()
    counts = stored(
        words.filter("alone").select("toxic", "word").unionByName(once.select("toxic", "word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .filter("bad > 0 or good > 0"),
        "text_counts",
    )
    # A passage that many toxic texts share shows its words once: a word counts in as many texts as it has neighbours there.
    cut = F.split(F.lower("text"), SPLIT)
    beside = lambda w, i: F.struct(w.alias("word"), F.xxhash64(F.get("cut", i - 1), F.get("cut", i + 1)).alias("beside"))
    placed = train.filter("toxic = 1").select(cut.alias("cut")).select(F.explode(F.transform("cut", beside)).alias("p")).select("p.*")
    places = placed.filter("length(word) between 3 and 40").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("places"))
    counts = stored(
        counts.join(places, "word", "left").select("word", F.least("bad", F.coalesce("places", F.lit(0))).alias("bad"), "good"), "word_counts"
    )
    stems = (
        counts.select("bad", "good", F.explode(F.array(*[F.lit(n) for n in STEMS])).alias("n"), "word")
        .filter(F.length("word") > F.col("n"))
        .groupBy(F.expr("substring(word, 1, n)").alias("word"))
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("forms"))
        .filter("forms > 2")
    )
    groups = train.select("group", "toxic").distinct().groupBy("toxic").count().collect()  # two
    sizes = {r["toxic"]: r["count"] for r in groups}
    chance = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    if not 0 < chance < 1:
        return Trie([], [])  # labels of one kind are evidence of nothing
    n = F.col("bad") + F.col("good")
    share = F.col("bad") / n
    divergence = share * F.log(share / chance) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
    seen = counts.filter(n >= MIN_TEXTS).count() + stems.filter(n >= MIN_TEXTS).count()
    needed = math.log(max(seen, 1) / FALSE_TERMS)
    passes = (F.col("bad") >= MIN_TEXTS) & (share >= MIN_SHARE) & (share > chance) & (n * divergence >= needed)
    terms = lambda df: [r.word for r in df.filter(passes).select("word").collect()]
    found = set(terms(stems))
    # A stem whose own start is a stem adds nothing.
    shortest = sorted(s for s in found if not any(s[:k] in found for k in STEMS if k < len(s)))
    words = sorted(terms(counts))
    trie = Trie(words, shortest)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, rows = [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                found = trie.near(word) if trie.kind(word) == 2 else []
                terms += found
                rows += [row] * len(found)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), batch.column("bad").take(at), batch.column("good").take(at)], names=["term", "bad", "good"]
            )

    near = counts.select("word", "bad", "good").mapInArrow(neighbours, "term string, bad long, good long")
    near = near.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))  # a row per term
    common = near.filter((F.col("good") > 0) & (F.col("bad") < MIN_SHARE * (F.col("bad") + F.col("good")))).collect()
    return Trie(words, shortest, frozenset(r.term for r in common))


def with_features(rows: DataFrame, trie: Trie) -> DataFrame:
    """(row, open, misspelled, quoted) of rows whose only column ``row`` is a struct with a field text.

    A struct carries whatever a table holds besides, whatever it is called.
    """
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.LongType()) for n in ("open", "misspelled", "quoted"))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = kept("toxic words", trie.name, dict)
        for batch in batches:
            row = batch.column("row")
            texts = pc.struct_field(row, "text")
            for part in slices(pa.RecordBatch.from_arrays([texts, row], names=["text", "row"]), "text", CHUNK_BYTES):
                hits = features(part.column("text"), trie, known)
                columns = [part.column("row"), *(pa.array(hits[:, k].copy()) for k in range(3))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "open", "misspelled", "quoted"])

    return rows.mapInArrow(work, schema)


def fit_weights(hits: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic weights drawn to PRIOR (a unit ridge), by Newton steps; without rows they are PRIOR."""
    x = np.column_stack([np.log1p(hits), np.ones(len(hits))])
    w = PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    # A hit never makes a text less toxic.
    w[:3] = np.maximum(w[:3], 0.0)
    return w


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Trie, np.ndarray]:
    """Lexicon and weights from the labelled rows that aren't held out."""
    train = labelled(docs, labels)
    trie = learn_lexicon(train)
    # A group is one row of the fit for each label, by the mean hits of its texts.
    sample = (
        with_features(train.select(F.struct("group", "text", "toxic").alias("row")), trie)
        .groupBy("row.group", "row.toxic").agg(*[F.avg(n).alias(n) for n in ("open", "misspelled", "quoted")])
        .orderBy(F.xxhash64(F.lit(7), "group"), "group", "toxic").limit(FIT_ROWS)
        .select("open", "misspelled", "quoted", "toxic").toPandas()
    )
    table = sample.to_numpy(dtype=np.float64).reshape(-1, 4)
    return trie, fit_weights(table[:, :3], table[:, 3])


def scored(rows: DataFrame, model: tuple[Trie, np.ndarray]) -> DataFrame:
    """``rows`` (row: struct with text) with hits and score."""
    trie, weights = model
    z = F.lit(float(weights[3]))
    for name, w in zip(("open", "misspelled", "quoted"), weights):
        z = z + F.log1p(F.col(name)) * float(w)
    return with_features(rows, trie).withColumn("score", 1 / (1 + F.exp(-z)))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, open, misspelled, quoted), one row per row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) teach only where they aren't held out; rows with a null label or doc_id teach nothing, of several
    labels of a doc_id the highest counts. Null and empty texts have no hits and the score of a text without any. Repeated rows score
    alike; without labels or lexicon the prior's constant is the score of every text. An empty table gives no row.
    """
    rows = docs.select(F.struct("doc_id", "text").alias("row"))
    return scored(rows, learn(docs, labels)).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "open", "misspelled", "quoted",
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, whose score is below 0.5."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return scored(whole, learn(docs, labels)).filter("score < 0.5").select("row.*")
