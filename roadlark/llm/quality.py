"""Quality classifier: a weak-label model and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on each document, for two aspects: the form of the
text and abuse in it.  The counts of all vote patterns over all documents go into an expectation
maximisation that estimates each labeller's accuracy and the share of bad documents.  The
posterior of each vote pattern is the training label of a linear scorer over hashed features,
which then decides on every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlark.llm.common import RollingSums, Scratch, distinct, slices, tidy, utf8

# Bounds of what is fetched to train: documents for the scorer, labelled documents and entries
# of the learned word list.  Votes, their accuracies and scores cover all documents.
TRAINING_ROWS = 5000
LABELLED_ROWS = 8000
ENTRIES = 1000
# An entry of the learned list is in so many toxic texts of the sample, and in such a share.
LEAST = 8
SHARE = 0.02
# Weight of documents without a person's label beside those with one.
LIGHT = 0.05

SLICE_BYTES = 1 << 19
CELLS = 1 << 18
RESERVED = 1024
BAD, GOOD, NONE = 0, 1, 2

# Frequent function words of four languages, and common insults.
FUNCTION_WORDS = (
    "the of and to in a is that it was for on are as with they be at this have from or by not but"
    " der die und das von zu mit sich des auf ist im dem nicht ein eine als auch es an er"
    " le la les de un une et que qui dans pour pas sur au du est elle avec en"
    " el los las y por con su para se del como al lo"
).split()
INSULTS = (
    "idiot moron stupid pathetic disgusting loser clown worthless trash scum dumb jerk imbecile"
    " bastard bitch retard crap asshole fuck fucking shit whore slut filthy vermin"
).split()

EDGES = np.array([0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.5, 0.8, 2, 4, 8, 14])

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "*#$%&|@^~<>{}=\\"])
_ROLLING = RollingSums(seed=23)

FORM = ("symbols", "capitals", "repeats", "calls", "function_words", "word_length", "signs", "variety")
ABUSE = ("insults", "learned_words", "learned_starts", "learned_pieces", "people")


def cuts(inside: np.ndarray, offsets: np.ndarray):
    """(start, end, text) of the runs of ``inside``, none across texts."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def hashes(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(_ROLLING.ranges(_ROLLING.sums(data), np.array([0]), np.array([len(data)]))[0])
    return np.sort(np.array(out, np.uint64))


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Indices of the values that are in the sorted array ``known``."""
    if not len(known):
        return np.empty(0, np.int64)
    known = known.astype(values.dtype)
    # Most values are ruled out by sixteen of their bits.
    low = np.zeros(1 << 16, bool)
    low[(known & known.dtype.type(0xFFFF)).astype(np.int64)] = True
    some = np.flatnonzero(low[values.astype(np.uint16)])
    at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    return some[known[at] == values[some]]


class Profile:
    """Statistics, word hashes and four-byte pieces of words, for a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.count = n = len(offsets) - 1

        text = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))

        def per_text(flags):
            return np.bincount(text[np.flatnonzero(flags)], minlength=n).astype(float)

        raw = ~((data == 32) | ((data >= 9) & (data <= 13)))
        start, end, owner = cuts(raw, offsets)
        sums = _ROLLING.sums(data)
        word = _ROLLING.ranges(sums, start, end)
        symbol = np.flatnonzero(_SYMBOL[data])
        marked = distinct(np.searchsorted(start, symbol, "right") - 1)
        again = np.zeros(len(word), bool)
        again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        self.words = words = np.bincount(owner, minlength=n).astype(float)
        some = np.maximum(words, 1)
        # Words are told apart by 40 bits within a text.
        new = distinct((owner.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
        new = (new >> np.uint64(40)).astype(np.int64)
        upper = per_text((data >= 65) & (data <= 90))
        lower = per_text(((data >= 97) & (data <= 122)) | (data >= 192))
        size = np.maximum(np.diff(offsets), 1)

        folded = np.frombuffer(data.tobytes().translate(_FOLD), np.uint8)
        begin, stop, self.owner = cuts(folded != 32, offsets)
        self.word = _ROLLING.ranges(_ROLLING.sums(folded), begin, stop)
        letters = np.maximum(np.bincount(self.owner, minlength=n), 1)
        known = np.bincount(self.owner[member(self.word, _FUNCTION)], minlength=n)
        self.stats = np.stack(
            [
                np.bincount(owner[marked], minlength=n) / some,
                upper / np.maximum(upper + lower, 1),
                np.bincount(owner[again], minlength=n) / some,
                per_text(data == 33) / some,
                known / letters,
                np.bincount(owner, weights=end - start, minlength=n) / some,
                np.bincount(text[symbol], minlength=n) / size,
                np.bincount(new, minlength=n) / np.minimum(some, 200),
            ],
            axis=1,
        )
        long = stop - begin >= 5
        first = begin[long]
        self.start = np.zeros(len(first), np.uint64)
        for k in range(5):
            self.start = (self.start << np.uint64(8)) | folded[first + k].astype(np.uint64)
        self.start_owner = self.owner[long]
        letter = folded != 32
        inside = letter[:-3] & letter[1:-2] & letter[2:-1] & letter[3:]
        inside &= text[:-3] == text[3:]
        at = np.flatnonzero(inside)
        four = folded.astype(np.uint32)
        piece = (four[:-3] << np.uint32(24)) | (four[1:-2] << np.uint32(16))
        piece |= (four[2:-1] << np.uint32(8)) | four[3:]
        self.piece, self.home = piece[at], text[at]

    def found(self):
        """(values, text of each): words, their starts of five bytes, all their pieces."""
        yield self.word, self.owner
        yield self.start, self.start_owner
        yield self.piece, self.home

    def votes(self, learned: list[np.ndarray]):
        """(form votes, abuse votes): one row per text; ``learned``: entries as from ``found``."""
        s, words = self.stats, self.words

        def vote(k, bad, good, least=8):
            out = np.where(bad(s[:, k]), BAD, np.where(good(s[:, k]), GOOD, NONE))
            return np.where(words >= least, out, NONE)

        form = [
            vote(0, lambda v: v > 0.15, lambda v: v < 0.05, 4),
            vote(1, lambda v: v > 0.5, lambda v: v < 0.2, 4),
            vote(2, lambda v: v > 0.3, lambda v: v < 0.1),
            vote(3, lambda v: v > 0.3, lambda v: v < 0.05, 4),
            vote(4, lambda v: v < 0.02, lambda v: v > 0.06, 20),
            vote(5, lambda v: (v > 14) | (v < 2), lambda v: (v > 2.5) & (v < 10)),
            vote(6, lambda v: v > 0.08, lambda v: v < 0.02, 4),
            vote(7, lambda v: v < 0.25, lambda v: v > 0.35),
        ]

        def hits(values, owner, known):
            found = owner[member(values, known)]
            # To hold no known word is no proof of anything.
            return np.where(np.bincount(found, minlength=self.count) > 0, BAD, NONE)

        abuse = [
            hits(self.word, self.owner, _INSULTS),
            *(hits(values, owner, known) for (values, owner), known in zip(self.found(), learned)),
        ]
        silent = words == 0
        return tuple(np.where(silent[:, None], NONE, np.stack(v, axis=1)) for v in (form, abuse))

    def form_features(self):
        """The cells of each text for its form: bins of the statistics, alone and two by two."""
        kinds = self.stats.shape[1]
        bins = np.searchsorted(EDGES, self.stats) + 16 * np.arange(kinds)
        a, b = np.triu_indices(kinds, 1)
        pairs = (bins[:, a] * 16 * kinds + bins[:, b]).astype(np.uint64)
        return np.concatenate((bins, spread(pairs)), axis=1)

    def abuse_features(self):
        """The cells of each text for abuse: the pieces of its words."""
        cell = spread(self.piece.astype(np.uint64))
        cut = np.searchsorted(self.home, np.arange(self.count + 1))
        return [distinct(cell[cut[i] : cut[i + 1]]) for i in range(self.count)]

    def scores(self, form: np.ndarray, abuse: np.ndarray):
        """(sum of form weights, sum of abuse weights) of each text."""
        cell = spread(self.piece.astype(np.uint64))
        some = np.flatnonzero(abuse[cell] != 0)  # most weights are zero
        pair = distinct(self.home[some].astype(np.int64) * CELLS + cell[some])
        home, cell = pair // CELLS, pair % CELLS
        total = np.bincount(home, weights=abuse[cell], minlength=self.count)
        return form[self.form_features()].sum(axis=1), total


def spread(values: np.ndarray) -> np.ndarray:
    """Cells beyond the reserved ones, by hash."""
    top = (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return RESERVED + (top % np.uint64(CELLS - RESERVED)).astype(np.int64)


_FUNCTION, _INSULTS = hashes(FUNCTION_WORDS), hashes(INSULTS)


def profiles(column: pa.Array):
    data, offsets = utf8(column)
    for i, j in slices(np.diff(offsets), SLICE_BYTES):
        yield i, j, Profile(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def labelled(documents: DataFrame, labels: DataFrame | None, rows: int) -> DataFrame:
    """(doc_id, toxic): at most ``rows`` labelled ids, the same at each run."""
    if labels is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, toxic int")
    known = labels.filter("doc_id is not null and toxic is not null")
    ids = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learned(documents: DataFrame, sample: DataFrame, entries: int):
    """Words, word starts and pieces that stand in toxic documents of a labelled sample and no others.

    Copies of one text count once, and an entry must be in a certain share of the toxic texts,
    so that words of a few near copies are not learned.
    """
    def run(batches):
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), bool)
            found = []
            for i, j, p in profiles(batch.column(0)):
                for kind, (values, owner) in enumerate(p.found()):
                    value, code = np.unique(values, return_inverse=True)
                    pair = np.unique(code.astype(np.int64) * p.count + owner)
                    found.append(
                        (kind, value[pair // p.count].astype(np.uint64), toxic[i:j][pair % p.count])
                    )
            for kind in range(3):
                mine = [(v, b) for k, v, b in found if k == kind]
                value = np.concatenate([v for v, _ in mine] or [np.empty(0, np.uint64)])
                bad = np.concatenate([b for _, b in mine] or [np.empty(0, bool)])
                value, code = np.unique(value, return_inverse=True)
                total = np.bincount(code, minlength=len(value))
                hits = np.bincount(code, weights=bad, minlength=len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(value), kind, np.int32)),
                        pa.array(value.view(np.int64)),
                        pa.array(hits),
                        pa.array(total - hits),
                    ],
                    names=["kind", "value", "bad", "good"],
                )

    texts = documents.filter("text is not null").join(sample, "doc_id").select("text", "toxic")
    texts = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))
    counts = texts.mapInArrow(tidy(run), "kind int, value long, bad long, good long")
    sums = counts.groupBy("kind", "value").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    toxic = texts.filter("toxic <> 0").count()
    kept = sums.filter((F.col("bad") >= max(LEAST, SHARE * toxic)) & (F.col("good") == 0))
    found = kept.orderBy(F.desc("bad"), "kind", "value").limit(entries).collect()
    kinds = [[r.value for r in found if r.kind == k] for k in range(3)]
    return [np.sort(np.array(values, np.int64).view(np.uint64)) for values in kinds]


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, silence: bool = False, rounds: int = 100
):
    """(posterior of good for each pattern, accuracies): one latent class, independent labellers.

    accuracies[j, y, v] is the probability that labeller j says v about documents of class y.
    It starts from the majority of the votes.  ``silence``: to say nothing is a vote, too, and
    the last labeller is a person, whose word is taken; this ties the classes to their meaning
    where the other labellers depend on each other.
    """
    good, bad = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    # One labeller that says bad already makes a document doubtful.
    posterior = np.where(bad == 0, 0.95, np.where(bad >= good, 0.05, 0.5 * good / np.maximum(good + bad, 1)))
    word = np.where(patterns[:, -1] == GOOD, 0.98, 0.02)
    taken = silence & (patterns[:, -1] != NONE)
    posterior = np.where(taken, word, posterior)
    labellers = patterns.shape[1] - silence
    if taken.any():  # beside a person's word, other documents count a little
        counts = np.where(taken, counts, LIGHT * counts)
    accuracy = np.zeros((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior], axis=1)
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        for v in (BAD, GOOD, NONE):
            accuracy[:, :, v] = (patterns == v).T.astype(float) @ weight + 0.5
        accuracy /= accuracy.sum(axis=2, keepdims=True)
        logs = np.log(prior)[None, :].repeat(len(patterns), axis=0)
        for j in range(labellers):
            said = (patterns[:, j] != NONE) | silence
            logs += np.where(said[:, None], np.log(accuracy[j][:, patterns[:, j]].T), 0.0)
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
        posterior = np.where(taken, word, posterior)
        if np.abs(before - posterior).max() < 1e-9:
            break
    return posterior, accuracy


def linear(cells: list[np.ndarray], target: np.ndarray, rounds: int = 60, sparsity: float = 5e-4):
    """(weights, bias) of a logistic scorer on soft targets, by full-batch proximal AdaGrad.

    The penalty on absolute weights leaves the cells at zero that tell little, so the noise of a
    long text's many cells does not add up.
    """
    index = np.concatenate(cells)
    sizes = np.array([len(c) for c in cells])
    row = np.repeat(np.arange(len(cells)), sizes)
    weights, bias = np.zeros(CELLS), 0.0
    seen, seen_bias = np.full(CELLS, 1e-8), 1e-8
    for _ in range(rounds):
        score = np.bincount(row, weights=weights[index], minlength=len(cells)) + bias
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - target
        step = np.bincount(index, weights=error[row], minlength=CELLS) / len(cells)
        seen += step * step
        rate = 0.5 / np.sqrt(seen)
        weights -= rate * step
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * sparsity, 0)
        seen_bias += error.mean() ** 2
        bias -= 0.5 * error.mean() / np.sqrt(seen_bias)
    return weights, bias


def trained(documents: DataFrame, labels: DataFrame | None, training_rows: int, labelled_rows: int):
    """One (weights, bias) per aspect."""
    scratch = Scratch(documents.sparkSession, "quality")
    human = scratch.keep(labelled(documents, labels, labelled_rows))
    lists = learned(documents, human, ENTRIES)

    def vote(batches):
        for batch in batches:
            form, abuse = [], []
            for _, _, p in profiles(batch.column(1)):
                f, a = p.votes(lists)
                form += ["".join(map(str, r)) for r in f.tolist()]
                abuse += ["".join(map(str, r)) for r in a.tolist()]
            columns = [batch.column(0), pa.array(form, pa.string()), pa.array(abuse, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "form", "abuse"])

    known = documents.filter("text is not null").select(F.col("doc_id").cast("long"), "text")
    votes = known.mapInArrow(vote, "doc_id long, form string, abuse string")
    # The labelled sample itself is one more labeller, silent about all other documents.
    said = F.when(F.col("toxic") != 0, str(BAD)).when(F.col("toxic") == 0, str(GOOD))
    abuse = F.concat("abuse", F.coalesce(said, F.lit(str(NONE))))
    votes = votes.join(human, "doc_id", "left").withColumn("abuse", abuse).drop("toxic")
    votes = scratch.keep(votes)
    posteriors = []
    for aspect in ("form", "abuse"):
        rows = votes.groupBy(aspect).count().orderBy(aspect).collect()  # at most 3 ** 8 patterns
        patterns = np.array([[int(c) for c in r[0]] for r in rows], np.int64)
        counts = np.array([r[1] for r in rows], float)
        # About form, silence tells of length only; the abuse labellers speak up on finds only.
        silence = aspect == "abuse"
        posterior = expectation_maximisation(patterns, counts, silence)[0] if rows else ()
        posteriors.append({r[0]: float(p) for r, p in zip(rows, posterior)})

    sample = votes.filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "form", "abuse")
    sample = sample.limit(training_rows).dropDuplicates(["doc_id"])

    def features(batches):
        for batch in batches:
            cells = [], []
            for _, _, p in profiles(batch.column(0)):
                for out, rows in zip(cells, (p.form_features(), p.abuse_features())):
                    out += [c.astype(np.int32).tobytes() for c in rows]
            columns = [*batch.columns[1:], *(pa.array(c, pa.binary()) for c in cells)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["form", "abuse", "form_cells", "abuse_cells"]
    joined = known.join(sample, "doc_id").select("text", "form", "abuse")
    schema = "form string, abuse string, form_cells binary, abuse_cells binary"
    # Sums run in one order, so reruns agree.
    rows = sorted(tuple(r) for r in joined.mapInArrow(features, schema).collect())
    out = []
    for k, posterior in enumerate(posteriors):
        target = np.array([posterior[r[k]] for r in rows])
        cells = [np.frombuffer(r[2 + k], np.int32).astype(np.int64) for r in rows]
        out.append(linear(cells, target) if rows else (np.zeros(CELLS), 0.0))
    return out


def classify(
    documents: DataFrame,
    labels: DataFrame | None = None,
    threshold: float = 0.5,
    least_harmless: float = 0.5,
    training_rows: int = TRAINING_ROWS,
    labelled_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """``documents`` with quality, harmless (probabilities of either aspect) and keep.

    keep holds where quality reaches ``threshold`` and harmless ``least_harmless``.  ``labels`` (doc_id, toxic) only feeds the word
    list of two of the labellers, from at most ``labelled_rows`` documents; without it they vote
    good on every text.  Null texts and texts without words have quality 0 and are not kept.
    Rows without doc_id are scored like others and do not train.  Repeated rows count and are
    scored each.  An empty table gives an empty result.  Other columns stay; columns named
    quality, harmless or keep are replaced.
    """
    plain = documents.drop("quality", "harmless", "keep")
    (form, form_bias), (abuse, abuse_bias) = trained(
        plain.select("doc_id", "text"), labels, training_rows, labelled_rows
    )
    both = np.stack([form, abuse])
    shared = documents.sparkSession.sparkContext.broadcast(both)  # CELLS numbers each
    bias = np.array([form_bias, abuse_bias])
    at = plain.columns.index("text")

    def run(batches):
        for batch in batches:
            scores = np.zeros((batch.num_rows, 2))
            for i, j, p in profiles(batch.column(at)):
                total = np.stack(p.scores(*shared.value), axis=1) + bias
                scores[i:j] = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
                scores[i:j][p.words == 0] = (0, 1)
            keep = (scores >= (threshold, least_harmless)).all(axis=1)
            columns = [*batch.columns, *(pa.array(c) for c in (scores[:, 0], scores[:, 1], keep))]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names, "quality", "harmless", "keep"]
            )

    schema = T.StructType(list(plain.schema))
    schema = schema.add("quality", "double").add("harmless", "double").add("keep", "boolean")
    return plain.mapInArrow(tidy(run), schema)
