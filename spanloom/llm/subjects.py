"""Subject areas of documents by labelling functions and a latent accuracy model (problem 9).

A text's sentences are its units.  Seven labelling functions vote for a subject, for *none*, or abstain: the **lexicon** (words,
per language) where it is sure and where it is less so, the subjects' **descriptions** (word stems), web and mail **addresses**,
the document's **section** and its **source**, and **silence**, which votes *none* where neither words nor addresses vote.  The
accuracy of each function but the last is learnt without truth, by expectation-maximisation over the votes of all sentences; a sentence goes to
its most probable class and a document to every subject with at least ``SHARE`` of its sentences.

The lexicon starts from hand-labelled documents (a bounded sample, ``MAX_LABELLED`` rows by hash of their id; a label is a
prior, not a truth, as some are wrong) and is then re-estimated ``ROUNDS`` times over the sentences of **all** documents, each sentence
counting with its class probabilities; the last round counts the addresses too.  A term that counts for less than ``LEAST_COUNT`` sentences
in the whole corpus has no weight.  Partial counts are combined per task before they are shuffled.  What reaches the driver
is bounded by parameters: the labelled sample, the ``MAX_TERMS`` heaviest terms of the model, and vote patterns, at most 11^7 and
in practice a few hundred.  The rarer terms of a larger model stay in a table and are joined to the documents that have them; as the
frequent ones are not, no key of that join is hot.  Sections and sources are looked up in a literal of at most ``MAX_GROUPS``,
or joined to the documents where they are more.  Texts are read once, votes are written once.

Defined results.  Null, empty and blank texts and texts without words: no subject.  Repeated documents give one row per subject.
Labels in other spellings count, unknown ones do not; a null label says that none was seen.  Without any labels only the
descriptions vote.  A subject without sentences has no row.  Empty tables give an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from spanloom.llm.lookalikes import same_form
from spanloom.plans.lineage import cut

SHARE = 0.2
MAX_LABELLED, MAX_TERMS, MAX_GROUPS = 5_000, 200_000, 10_000
ROUNDS, SEED_ROUNDS, LEAST_COUNT = 2, 8, 2
_SURE, _UNSURE = 4.0, 0.5  # leads of the best class, in log likelihood, at which the lexicon votes
_LEAST_TERMS = 3  # a sentence of fewer words says too little for the lexicon to vote
_FLUSH = 200_000  # distinct terms a task holds before it passes its counts on
_BITS, _HOST = 56, 8  # a term is its language (addresses: 8) above a hash of 56 bits
FUNCTIONS = ["lexicon", "descriptions", "addresses", "section", "source", "lexicon_unsure", "silence"]
_BELIEF = [0.95, 0.7, 0.7, 0.4, 0.4, 0.8, 0.95]  # accuracies before any vote is seen

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_ADDRESS = re.compile(r"(?:https?://|www\.|@)([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
#: Frequent function words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and in to was were for that this is are with by no at on one we",
    "de": "der die das und für wurden nicht in ließen sich keine über alle zusammen ob ist diese nachdem worden waren wir den zu",
    "es": "de en los las el la se no que por si con sin una un al hubo fue estos entre tras",
    "fr": "le la les des et dans pour une un est sont du au que sur pas",
}
_LANGUAGES = [(k, frozenset(v.split())) for k, v in FUNCTION_WORDS.items()]


def split_sentences(text: str | None) -> list[tuple[str, list[str]]]:
    """The units of a text that have at least three letters, each with its words."""
    if not text:
        return []
    units = [(s, _WORD.findall(s.lower())) for s in _SENTENCE.split(same_form_lines(text))]
    return [u for u in units if len(u[1]) > 2 or sum(map(len, u[1])) > 2]


def sentences(text: str | None) -> list[str]:
    return [s for s, _ in split_sentences(text)]


def same_form_lines(text: str) -> str:
    """The text in one form, line by line (line ends separate sentences)."""
    return text if text.isascii() else "\n".join(map(same_form, text.splitlines()))


def code(word: str) -> int:
    return int.from_bytes(blake2b(word.encode("utf-8", "surrogatepass"), digest_size=7).digest())


def language(words: Counter) -> int:
    return max(range(len(_LANGUAGES)), key=lambda k: (sum(words[w] for w in _LANGUAGES[k][1] & words.keys()), -k))


def _stem(word: str) -> str:
    return word[:-1] if len(word) > 5 else word


class Reader:
    """Texts to terms; remembers, within a bound, what it has made of a word."""

    def __init__(self, stems: dict[str, int]) -> None:
        self.stems = stems
        self.known: list[dict[str, int]] = [{} for _ in _LANGUAGES]  # -1 for short words
        self.hitting: dict[str, frozenset[str]] = {}
        self.marked: set[str] = set()

    def word(self, w: str, lang: int) -> int:
        if len(self.known[lang]) >= _FLUSH:
            self.known[lang].clear()
        self.known[lang][w] = out = lang << _BITS | code(w) if len(w) > 2 else -1
        if stems := frozenset(x for x in (w, _stem(w)) if x in self.stems):
            self.hitting[w] = stems
            self.marked.add(w)
        return out

    def terms(self, text: str | None) -> tuple[bytes, bytes, bytes, bytes, bytes]:
        """The text's terms (64 bits each) and how many each sentence has, its sentences' votes by the descriptions (-1:
        abstains), its addresses and how many each sentence has: arrays as bytes, which pass between the JVM and Python as they are."""
        units = split_sentences(text)
        lang = language(Counter(w for _, ws in units for w in ws))
        get, word, hitting, marked = self.known[lang].get, self.word, self.hitting, self.marked
        flat, lengths, votes, hosts, n_hosts = array("q"), array("i"), array("b"), array("q"), array("i", bytes(4 * len(units)))
        for _, ws in units:
            once = set(ws)
            own = [c for w in once if (c := get(w) or word(w, lang)) >= 0]
            flat.extend(own)
            lengths.append(len(own))
            if not marked.isdisjoint(once):
                hits = Counter(self.stems[x] for x in {x for w in marked & once for x in hitting[w]}).most_common(2)
                votes.append(hits[0][0] if len(hits) == 1 or hits[0][1] > hits[1][1] else -1)
            else:
                votes.append(-1)
        if text and ("www." in text or "://" in text or "@" in text or not text.isascii()):
            for i, (s, _) in enumerate(units):
                own = [_HOST << _BITS | code(h.lower()) for h in _ADDRESS.findall(s)]
                hosts.extend(own)
                n_hosts[i] = len(own)
        return flat.tobytes(), lengths.tobytes(), votes.tobytes(), hosts.tobytes(), n_hosts.tobytes()


def _numbers(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


class Terms:
    """Lists of terms as one array and the list each term is in."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat, self.lengths = flat, lengths
        self.of = np.repeat(np.arange(len(lengths)), lengths)

    @classmethod
    def of_batch(cls, batch: pa.RecordBatch, column: str) -> Terms:
        """The terms or addresses of the sentences of all documents of a batch."""
        return cls(_numbers(batch.column(column), np.int64), _numbers(batch.column(f"n_{column}"), np.int32))


def _places(batch: pa.RecordBatch) -> np.ndarray:
    """The document of each sentence of a batch, by its place."""
    return np.repeat(np.arange(batch.num_rows), [len(x) for x in batch.column("described").to_pylist()])


def _weights(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Log likelihood ratios of terms (rows) by class: shrunk to 0 for classes with little text, equally low for unseen."""
    base = count.sum(1, keepdims=True) / max(total.sum(), 1e-9)
    trust = total / (total + 50.0)
    ratio = count / np.maximum(total, 1e-9) / base
    return np.log((ratio * trust + (1 - trust) + 0.05) / 1.05)


class Lexicon:
    """Terms and their weights by class; ``rest`` (term, weight) has those that are too many to be held."""

    rest: DataFrame | None = None

    def __init__(self, keys: np.ndarray, count: np.ndarray, totals: dict[int, np.ndarray] | None = None) -> None:
        """``totals``: the counts of all terms by language, if ``keys`` are not all."""
        order = np.argsort(keys)
        self.keys, count = keys[order], count[order]
        self.weight = np.zeros_like(count)
        for lang in np.unique(self.keys >> _BITS):
            own = self.keys >> _BITS == lang
            self.weight[own] = _weights(count[own], count[own].sum(0) if totals is None else totals[int(lang)])

    @classmethod
    def of_weights(cls, keys: np.ndarray, weight: np.ndarray) -> Lexicon:
        """``keys`` in their order and their weights."""
        out = cls(np.zeros(0, np.int64), np.zeros((0, weight.shape[1])))
        out.keys, out.weight = keys, weight
        return out

    @classmethod
    def of_rest(cls, batch: pa.RecordBatch, column: str, classes: int) -> Lexicon:
        """The joined rarer terms of a batch's documents."""
        keys = batch.column(f"{column}_rest").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        weight = batch.column(f"{column}_weights").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, classes)
        keys, at = np.unique(keys, return_index=True)
        return cls.of_weights(keys, weight[at])

    def scores(self, terms: Terms, classes: int) -> np.ndarray:
        """Summed weights of each list of terms."""
        out = np.zeros((len(terms.lengths), classes))
        if len(terms.flat) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, terms.flat), len(self.keys) - 1)
            known = self.keys[at] == terms.flat
            of, at = terms.of[known], at[known]
            for k in range(classes):
                out[:, k] = np.bincount(of, self.weight[at, k], len(out))
        return out


def _soft(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True)) if len(scores) else scores
    return e / e.sum(1, keepdims=True)


def _count(terms: Terms, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of the lists and the sums of their sentences' shares."""
    keys, inverse = np.unique(terms.flat, return_inverse=True)
    out = np.zeros((len(keys), share.shape[1]))
    for k in range(share.shape[1]):
        out[:, k] = np.bincount(inverse, share[terms.of, k], len(keys))
    return keys, out


def tokenised(documents: DataFrame, stems: dict[str, int]) -> DataFrame:
    """(doc_id, source, section, terms, n_terms, described, hosts, n_hosts, row), written once and read by every later pass."""
    names = ["doc_id", "source", "section", "terms", "n_terms", "described", "hosts", "n_hosts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(stems).terms
        for batch in batches:
            made = [read(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array([m[k] for m in made], pa.binary()) for k in range(5))], names)

    out = documents.select("doc_id", "source", "section", "text").mapInArrow(
        run, "doc_id long, source string, section string, terms binary, n_terms binary, described binary, hosts binary, n_hosts binary")
    return cut(out.where(F.length("described") > 0).withColumn("row", F.monotonically_increasing_id()))


def _with_rest(docs: DataFrame, column: str, lexicon: Lexicon) -> DataFrame:
    """``docs`` plus the terms of ``column`` that only the lexicon's rest has, and their weights, term by term."""
    names = [f"{column}_rest", f"{column}_weights"]
    if lexicon.rest is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(lexicon.keys)

    def rarer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = Terms.of_batch(batch, column)
            place = _places(batch)[terms.of]
            rare = ~np.isin(terms.flat, shared.value)
            pairs = np.unique(np.stack([place[rare], terms.flat[rare]], 1), axis=0)
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(rows[pairs[:, 0]], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["row", "term"])

    met = docs.select("row", column, f"n_{column}", "described").mapInArrow(rarer, "row long, term long").join(lexicon.rest, "term")
    met = met.groupBy("row").agg(F.collect_list(F.struct("term", "weight")).alias("met"))
    met = met.select("row", F.col("met.term").alias(names[0]), F.flatten("met.weight").alias(names[1]))
    return docs.join(met, "row", "left")


def _seed_lexicon(sample: list, classes: int) -> Lexicon:
    """The lexicon of the labelled sample: (terms, labels) rows; a label raises the prior of its class."""
    lists, prior = [], []
    for row in sample:
        p = np.full(classes, 0.01)
        for k in row["labels"]:
            p[k] = 0.8 / len(row["labels"])
        p[-1] = 0.2 if row["labels"] else 0.9
        lists.append((row["terms"], row["n_terms"]))
        prior += [np.log(p / p.sum())] * (len(row["n_terms"]) // 4)
    if not prior:
        return Lexicon(np.zeros(0, np.int64), np.zeros((0, classes)))
    prior, lists = np.array(prior), Terms(*(np.frombuffer(b"".join(x), k) for x, k in zip(zip(*lists), (np.int64, np.int32))))
    share = _soft(prior)
    for _ in range(SEED_ROUNDS):
        lexicon = Lexicon(*_count(lists, share))
        share = _soft(prior + lexicon.scores(lists, classes))
    return Lexicon(*_count(lists, share))


def _corpus_lexicon(docs: DataFrame, lexicon: Lexicon, classes: int, hosts: bool) -> list[Lexicon]:
    """The lexicon re-estimated over all sentences, each counting with its class probabilities, and with ``hosts`` that of the
    addresses too.

    The ``MAX_TERMS`` heaviest terms are held, the others are the lexicon's rest.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.keys, lexicon.weight))
    names = [f"c{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon.of_weights(*shared.value)
        held: dict[int, np.ndarray] = {}

        def states() -> pa.RecordBatch:
            table = np.array(list(held.values())) if held else np.zeros((0, classes))
            keys = pa.array(list(held), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([keys, *(pa.array(table[:, k], pa.float64()) for k in range(classes))], ["term", *names])

        prior = np.log(np.array([0.8 / (classes - 1)] * (classes - 1) + [0.2]))
        for batch in batches:
            words = Terms.of_batch(batch, "terms")
            score = own.scores(words, classes)
            if lexicon_has_rest:
                score += Lexicon.of_rest(batch, "terms", classes).scores(words, classes)
            share = _soft(score + prior)
            for target in (words, Terms.of_batch(batch, "hosts")) if hosts else (words,):
                keys, counts = _count(target, share)
                for key, c in zip(keys.tolist(), counts):
                    have = held.get(key)
                    held[key] = c if have is None else have + c
            if len(held) >= _FLUSH:
                yield states()
        yield states()

    lexicon_has_rest = lexicon.rest is not None
    partial = _with_rest(docs.drop("doc_id", "source", "section"), "terms", lexicon).mapInArrow(run, "term long, " + ", ".join(f"{n} double" for n in names))
    total = sum((F.col(n) for n in names), F.lit(0.0))
    counts = cut(partial.groupBy("term").agg(*[F.sum(n).alias(n) for n in names]).where(total >= LEAST_COUNT))
    is_host = F.col("term") >= F.lit(_HOST << _BITS)
    return [_held(counts.where(part), names, total) for part in ([~is_host, is_host] if hosts else [~is_host])]


def _held(counts: DataFrame, names: list[str], total: Column) -> Lexicon:
    """The lexicon of counted terms."""
    rows = counts.orderBy(total.desc(), "term").limit(MAX_TERMS).toPandas()
    keys, count = rows["term"].to_numpy(np.int64), rows[names].to_numpy(float)
    if len(keys) < MAX_TERMS or counts.count() <= len(keys):
        return Lexicon(keys, count)
    by = counts.groupBy(F.shiftright("term", _BITS).alias("lang")).agg(*[F.sum(n).alias(n) for n in names]).collect()
    totals = {r["lang"]: np.array([r[n] for n in names]) for r in by}
    out = Lexicon(keys, count, totals)
    large = counts.sparkSession.sparkContext.broadcast(out.keys)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term = batch.column(0).to_numpy(zero_copy_only=False)
            rare = ~np.isin(term, large.value)
            made = Lexicon(term[rare], np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], 1)[rare], totals)
            yield pa.RecordBatch.from_arrays([pa.array(made.keys, pa.int64()), pa.array(list(made.weight), pa.list_(pa.float64()))], ["term", "weight"])

    out.rest = cut(counts.select("term", *names).mapInArrow(weigh, "term long, weight array<double>"))
    return out


def _with_group_vote(docs: DataFrame, column: str, labelled: DataFrame) -> DataFrame:
    """``docs`` with ``by_<column>``: the subject that at least half of the labelled documents of its source or section have, if any."""
    per = docs.select("doc_id", column).join(labelled, "doc_id")
    sizes = per.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    hits = per.select(column, F.explode("labels").alias("k")).groupBy(column, "k").agg(F.count(F.lit(1)).alias("hit"))
    best = hits.groupBy(column).agg(F.max(F.struct("hit", (-F.col("k")).alias("k"))).alias("b"))
    told = cut(sizes.join(best, column).where((F.col("n") >= 5) & (F.col("b.hit") * 2 >= F.col("n"))).select(column, (-F.col("b.k")).cast("int").alias("k")))
    if told.count() > MAX_GROUPS:
        return docs.join(told.withColumnRenamed("k", f"by_{column}"), column, "left")
    few = F.from_json(F.lit(json.dumps({r[column]: r["k"] for r in told.collect()})), "map<string,int>")
    return docs.withColumn(f"by_{column}", few[F.col(column)])


def fit_accuracies(patterns: np.ndarray, count: np.ndarray, classes: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(class prior, accuracy per function) of the latent model, from vote patterns (-1: abstains) and their counts.

    A function that votes is right with its accuracy and else names any other class alike.  That of silence stays as believed:
    hardly any other function votes where it does, so the votes cannot tell it.
    """
    functions = patterns.shape[1]
    accuracy, prior = np.array(_BELIEF)[:functions], np.full(classes, 1.0 / classes)
    voted = patterns >= 0
    for _ in range(rounds):
        share = posterior(patterns, prior, accuracy)
        prior = (share * count[:, None]).sum(0) + 1.0
        prior /= prior.sum()
        right = np.take_along_axis(share, np.maximum(patterns, 0), 1) * voted * count[:, None]
        learnt = (right.sum(0) + 1.0) / ((voted * count[:, None]).sum(0) + 2.0)
        accuracy = np.where(np.arange(functions) == FUNCTIONS.index("silence"), accuracy, learnt)
        accuracy = np.clip(accuracy, 1.0 / classes, 0.9999)
    return prior, accuracy


def posterior(patterns: np.ndarray, prior: np.ndarray, accuracy: np.ndarray) -> np.ndarray:
    """Class probabilities of each vote pattern."""
    score = np.tile(np.log(prior), (len(patterns), 1))
    classes = len(prior)
    for j, a in enumerate(accuracy):
        rows = np.flatnonzero(patterns[:, j] >= 0)
        score[rows, patterns[rows, j]] += np.log(a) - np.log((1 - a) / (classes - 1))
    return _soft(score)


def _labels(labels: DataFrame, subjects: list[str]) -> DataFrame:
    """(doc_id, labels): the classes labelled, empty where none was seen."""
    key = lambda c: F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]", "")
    names = F.array(*[F.lit(re.sub(r"[\W_]", "", s.lower())) for s in subjects])
    number = F.array_position(names, key(F.col("subject"))).cast("int") - 1
    known = labels.where("doc_id IS NOT NULL").select("doc_id", F.when(F.col("subject").isNotNull(), number).alias("k")).where("k IS NULL OR k >= 0")
    return known.groupBy("doc_id").agg(F.array_sort(F.collect_set("k")).alias("labels"))


def assign(documents: DataFrame, areas: DataFrame, labels: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, subject, n_sentences, n_subject) of every document and subject with enough of its sentences."""
    return fit(documents, areas, labels, share)["assigned"]


def fit(documents: DataFrame, areas: DataFrame, labels: DataFrame, share: float = SHARE) -> dict[str, DataFrame]:
    """``assigned``, see :func:`assign`, and ``quality``: (function, accuracy, votes, followed) of every labelling function, the
    last being the share of its votes that the model's classes agree with."""
    spark = documents.sparkSession
    rows = areas.where("subject IS NOT NULL").select("subject_id", "subject", F.coalesce("description", F.lit("")).alias("description")).orderBy("subject_id").collect()
    subjects = [r["subject"] for r in rows]
    out, told_of = "doc_id long, subject string, n_sentences int, n_subject int", "function string, accuracy double, votes long, followed double"
    if not subjects:
        return {"assigned": spark.createDataFrame([], out), "quality": spark.createDataFrame([], told_of)}
    classes = len(subjects) + 1
    told = Counter((_stem(w.lower()), k) for k, r in enumerate(rows) for w in set(_WORD.findall(r["subject"].replace("_", " ") + " " + r["description"])) if len(w) > 3)
    owners = Counter(w for w, _ in told)
    stems = {w: k for w, k in told if owners[w] == 1}
    docs = tokenised(documents, stems)
    labelled = cut(_labels(labels, subjects))
    sample = docs.select("doc_id", "terms", "n_terms").join(labelled, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).collect()
    lexicon, hosts = _seed_lexicon(sample, classes), None
    for i in range(ROUNDS):
        lexicon, *more = _corpus_lexicon(docs, lexicon, classes, i == ROUNDS - 1)
    hosts = more[0]
    cast_by = _with_group_vote(_with_group_vote(docs, "section", labelled), "source", labelled)
    cast_by = _with_rest(_with_rest(cast_by, "terms", lexicon), "hosts", hosts)
    rests = lexicon.rest is not None, hosts.rest is not None
    shared = spark.sparkContext.broadcast((lexicon.keys, lexicon.weight, hosts.keys, hosts.weight))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every document's sentences with the same votes, counted."""
        words, found = Lexicon.of_weights(*shared.value[:2]), Lexicon.of_weights(*shared.value[2:4])
        for batch in batches:
            place = _places(batch)
            cast = np.full((len(place), len(FUNCTIONS)), -1, np.int64)
            for j, (lex, column) in enumerate(((words, "terms"), (found, "hosts"))):
                units = Terms.of_batch(batch, column)
                score = lex.scores(units, classes)
                if rests[j]:
                    score += Lexicon.of_rest(batch, column, classes).scores(units, classes)
                if len(score):
                    two = np.partition(score, classes - 2, 1)[:, -2:]
                    margin = np.where(units.lengths >= (_LEAST_TERMS if j == 0 else 1), two[:, 1] - two[:, 0], 0.0)
                    cast[:, 2 * j] = np.where(margin > (_SURE if j == 0 else _UNSURE), score.argmax(1), -1)
                    if j == 0:
                        cast[:, 5] = np.where((margin > _UNSURE) & (margin <= _SURE), score.argmax(1), -1)
            cast[:, 1] = _numbers(batch.column("described"), np.int8)
            for j, column in ((3, "by_section"), (4, "by_source")):
                cast[:, j] = batch.column(column).fill_null(-1).to_numpy(zero_copy_only=False)[place]
            cast[:, 6] = np.where((cast[:, [0, 1, 2, 5]] < 0).all(1), classes - 1, -1)
            packed = ((cast + 1) * (classes + 1) ** np.arange(len(FUNCTIONS))).sum(1)
            pairs, n = np.unique(np.stack([place, packed], 1), axis=0, return_counts=True) if len(place) else (np.zeros((0, 2), int), np.zeros(0, int))
            ids = batch.column("doc_id").take(pa.array(pairs[:, 0]))
            rows = batch.column("row").take(pa.array(pairs[:, 0]))
            yield pa.RecordBatch.from_arrays([rows, ids, pa.array(pairs[:, 1], pa.int64()), pa.array(n, pa.int32())], ["row", "doc_id", "votes", "n"])

    votes = cut(cast_by.mapInArrow(vote, "row long, doc_id long, votes long, n int"))
    seen = votes.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()
    packed, counts = np.array([r["votes"] for r in seen], np.int64), np.array([r["n"] for r in seen], float)
    patterns = packed[:, None] // (classes + 1) ** np.arange(len(FUNCTIONS)) % (classes + 1) - 1
    prior, accuracy = fit_accuracies(patterns, counts, classes)
    best = posterior(patterns, prior, accuracy).argmax(1) if len(patterns) else np.zeros(0, int)
    named = spark.createDataFrame([(int(v), subjects[k] if k < classes - 1 else None) for v, k in zip(packed, best)], "votes long, subject string")
    # a document's sentences meet their class; its parts are a row for each of its patterns
    sized = votes.join(F.broadcast(named), "votes").groupBy("row", "doc_id", "subject").agg(F.sum("n").cast("int").alias("n_subject"))
    whole = W.partitionBy("row")
    sized = sized.withColumn("n_sentences", F.sum("n_subject").over(whole).cast("int")).where(F.col("subject").isNotNull() & (F.col("n_subject") >= F.col("n_sentences") * share - 1e-9))
    voted = patterns >= 0
    quality = [(name, float(round(accuracy[j], 6)), int(counts[voted[:, j]].sum()), float(round(counts[voted[:, j] & (patterns[:, j] == best)].sum() / max(counts[voted[:, j]].sum(), 1.0), 6))) for j, name in enumerate(FUNCTIONS)]
    return {"assigned": sized.select("doc_id", "subject", "n_sentences", "n_subject"), "quality": spark.createDataFrame(quality, told_of)}
