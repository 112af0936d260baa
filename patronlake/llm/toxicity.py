"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Learning. Labelled rows that are not held out give at most `MAX_EXAMPLES` examples, those with the least
hash of their id, and of equal texts one. Terms are lower-case words and their beginnings of 4 and 5
letters, all of them; they are known by their 64-bit XXH64. A term weighs (1 + ln count) x IDF x (1 + G),
with G2 the likelihood ratio of term and label: terms that speak for either label lead. Examples are unit
vectors of these weights.

Index. Examples of like common words (of one language, say) form clusters, and these are cut into blocks of
`BLOCK`. Terms of one in `COMMON` examples of a cluster or more, at most `COMMON_TERMS`, are common there:
their postings are columns of the cluster with the greatest weight of each block beside them. All others
have sparse postings.

Search. Texts of up to `LETTERS_AT_ONCE` letters are cut into words together, and each of their different
terms is looked up once. `AT_ONCE` texts are searched together. A text's sparse postings are added up for each example. With
the block's greatest weights of the common terms this bounds an example's similarity from above. The cluster
with the greatest bound is opened first, for all texts that lead to it in one matrix product. Further ones
are opened in that way where many of their examples have bounds that reach the k-th best score. All other
examples are opened from the greatest bound down, some more each time, until no closed one's bound reaches
the k-th best score. What may be among the k nearest is scored again in double precision and rounded to 12
places, so that ties are ties; these go to the smaller id.

Score. The neighbours vote with their similarities. Votes of the examples, each found by the other folds,
are turned into rates of toxicity by isotonic regression; this calibration maps a text's vote to its score.
A text without any known term, so an empty one too, gets the rate of examples without any. Evidence is the
nearest examples with label and similarity.

The index has the terms of at most `MAX_EXAMPLES` rows, some 6 bytes for each term of an example, so it
may be broadcast; all texts are scored whole.

Defined results: a NULL text is empty; NULL labels teach nothing, of several labels of an id the
greatest holds; without any examples the score is 0.5; NULL ids are scored, and count as held out by
the hash of the empty text; repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlake.llm.shared import Workspace, prepare, required, whole_text

MAX_EXAMPLES = 10_000
NEIGHBOURS = 16
BLOCK = 8  # examples to a block
COMMON, COMMON_TERMS = 16, 2048
OPENED = 64  # examples that are opened first; twice as many each further time
AT_ONCE = 128  # texts whose bounds are computed together
TOGETHER = 4  # texts from which on a cluster is opened by a matrix product
PRODUCT = 32  # times as much costs an example that is opened by itself
FOLDS = 5
CLUSTERS, PIVOTS, PIVOT_TERMS = 8, 64, 256
PULL = 0.25
NO_TERM = ""  # stands for a beginning that a word is too short for
THRESHOLD = 0.7
BUILT_AT_ONCE = 500  # examples whose terms are unpacked together; the driver is small
LETTERS_AT_ONCE = 2**22  # of texts that are cut into words together
SLACK = 1e-5  # of sums in single precision

_LETTERS = re.compile(r"[^\W\d_]+")
_TERMS = "doc_id long, label int, hashes binary, counts binary"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def terms_of_word(word: str) -> tuple[str, str, str]:
    """The word, and its beginnings marked as such."""
    return word, f"{word[:4]}*" if len(word) > 4 else NO_TERM, f"{word[:5]}*" if len(word) > 5 else NO_TERM


def words(text: str) -> Counter:
    return Counter(_LETTERS.findall(text.lower()))


def term_counts(text: str) -> Counter:
    found: Counter = Counter()
    for word, n in words(text).items():
        for term in terms_of_word(word):
            if term:
                found[term] += n
    return found


def hashed(term: str) -> int:
    return xxhash.xxh64_intdigest(term)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


@cache
def _letters() -> np.ndarray:
    """Of each code point whether it may be part of a word."""
    codes = np.arange(sys.maxunicode + 1, dtype="<u4")
    found = np.zeros(len(codes), bool)
    found[_codes("".join(_LETTERS.findall(codes.tobytes().decode("utf-32-le", "ignore"))))] = True  # but for surrogates
    return found


def words_of_all(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray, np.ndarray]:
    """`words` of some texts: the different words, and (text, word, count) by their numbers, ordered by text."""
    lower = [text.lower() for text in texts]
    joined = "\n".join(lower)
    codes = _codes(joined)
    edge = np.flatnonzero(np.diff(_letters()[codes], prepend=False, append=False))  # starts and ends in turn
    data, at = joined.encode(), edge
    if len(data) > len(codes):
        more = sum((codes > last).view(np.uint8) for last in (0x7F, 0x7FF, 0xFFFF))
        at = edge + np.concatenate([[0], np.cumsum(more, dtype=np.int64)])[edge]
    if not len(edge):
        at = np.zeros(1, np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
    found = pieces.take(pa.array(np.arange(0, len(pieces), 2))).dictionary_encode()
    text = np.searchsorted(np.cumsum([len(x) + 1 for x in lower]), edge[::2], side="right")
    many = max(1, len(found.dictionary))
    pair, count = np.unique(text * many + found.indices.to_numpy(), return_counts=True)
    return found.dictionary, *np.divmod(pair, many), count


def _example_terms(batches):
    for batch in batches:
        hashes, counts = [], []
        for text in batch.column(2):
            found = term_counts(text.as_py())
            hashes.append(np.fromiter(map(hashed, found), np.uint64, len(found)).tobytes())
            counts.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())],
            names=["doc_id", "label", "hashes", "counts"],
        )


def _unpacked(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The arrays that the binary values of a column hold, without copies."""
    found = []
    for chunk in column.cast(pa.large_binary()).chunks:
        _, ends, data = chunk.buffers()
        data = np.frombuffer(data or b"", np.uint8)
        at = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else ()
        found += [data[a:b].view(kind) for a, b in pairwise(at)]
    return found


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _parts(bounds: np.ndarray):
    """(first example, end, their entries) of a few examples at a time."""
    for first in range(0, len(bounds) - 1, BUILT_AT_ONCE):
        end = min(first + BUILT_AT_ONCE, len(bounds) - 1)
        yield first, end, slice(bounds[first], bounds[end])


class Index:
    """Labelled unit vectors in blocks, and the blocks of each term."""

    def __init__(self, docs, labels, hashes, counts, neighbours: int = NEIGHBOURS, calibrate: bool = True):
        """Of each example its id, its label, and hashes of its terms with their counts. Without `calibrate`
        `knots` are to be set to the `calibration` of all `votes`."""
        self.k = neighbours
        docs, labels = np.asarray(docs, np.int64), np.asarray(labels, np.float64)
        size = np.array([len(h) for h in hashes], np.int64)
        blank = labels[size == 0]
        full = np.flatnonzero(size)
        full = full[np.argsort(docs[full], kind="stable")]
        n = len(full)
        total = n + len(blank)
        prior = (labels.sum() + 1) / (total + 2)
        self.blank_score = float((blank.sum() + prior) / (len(blank) + 1)) if total else 0.5
        size = size[full]
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        term = np.empty(bounds[-1], np.int32)
        count = np.empty(bounds[-1], np.min_scalar_type(max((int(counts[i].max()) for i in full), default=0)))
        own = []
        for first, end, part in _parts(bounds):
            here, term[part] = np.unique(np.concatenate([hashes[i] for i in full[first:end]]), return_inverse=True)
            count[part] = np.concatenate([counts[i] for i in full[first:end]])
            own.append(here)
        self.terms = np.unique(np.concatenate([np.empty(0, np.uint64), *own]))
        a, b = np.zeros((2, len(self.terms)), np.int64)
        for here, (first, end, part) in zip(own, _parts(bounds)):
            term[part] = np.searchsorted(self.terms, here)[term[part]]
            toxic = np.repeat(labels[full[first:end]] == 1, size[first:end])
            a += np.bincount(term[part][toxic], minlength=len(self.terms))
            b += np.bincount(term[part][~toxic], minlength=len(self.terms))
        # numbered by frequency, so that what most entries look up lies close together
        frequent = np.argsort(-(a + b), kind="stable")
        self.number = np.empty(len(self.terms), np.int32)
        self.number[frequent] = np.arange(len(self.terms))
        a, b = a[frequent], b[frequent]
        for first, end, part in _parts(bounds):
            here = self.number[term[part]]
            by_term = np.lexsort((here, np.repeat(np.arange(end - first), size[first:end])))
            term[part], count[part] = here[by_term], count[part][by_term]
        marked = int((labels[full] == 1).sum())
        self.idf = (np.log((1 + n) / (1 + a + b)) + 1) * (1 + np.sqrt(likelihood_ratio(a, b, marked, n - marked)))
        order, self.starts = self._order(term, count, bounds, a + b)
        self.docs, self.labels = docs[full][order], labels[full][order]
        self.bounds = np.concatenate([[0], np.cumsum(size[order])]).astype(np.int64)
        self.term, self.count = np.empty_like(term), np.empty_like(count)
        for first, end, part in _parts(self.bounds):
            take = _ranges(bounds[order[first:end]], size[order[first:end]])
            self.term[part], self.count[part] = term[take], count[take]
        self.fold = np.argsort(np.argsort(self.docs, kind="stable")) % FOLDS
        del term, count
        self._unfolded = False
        self.knots = calibration(np.empty(0), self.labels)
        if calibrate:
            self.knots = calibration(self.votes(range(n)), self.labels)

    def _unfold(self) -> None:
        """Weights and postings. They follow from terms and counts, which alone are sent to the executors,
        and are made where texts are searched."""
        if self._unfolded:
            return
        n = len(self.docs)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.bounds))
        self.weight = self._weights(row, self.term, self.count, n)
        self._post(row)
        self._query = np.zeros(len(self.terms))
        self._unfolded = True

    def __getstate__(self):
        own = ("weight", "posts", "size", "begin", "column", "dense", "peaks", "_query")
        return {name: value for name, value in self.__dict__.items() if name not in own} | {"_unfolded": False}

    def _weights(self, row, term, count, n: int) -> np.ndarray:
        weight = (1 + np.log(count, dtype=np.float64)) * self.idf[term]
        return weight / np.sqrt(np.bincount(row, weight * weight, n))[row]

    def _order(self, term, count, bounds, found) -> tuple[np.ndarray, np.ndarray]:
        """Examples by cluster and, within, by the nearest of some of them, as far as the most frequent terms
        tell; and where each cluster starts, with the end."""
        n = len(bounds) - 1
        if not n:
            return np.arange(0), np.zeros(1, np.int64)
        frequent = np.argsort(-found, kind="stable")[:PIVOT_TERMS]
        place = np.full(len(found), -1, np.int32)
        place[frequent] = np.arange(len(frequent))
        dense = np.zeros((n, len(frequent)), np.float32)
        for first, end, part in _parts(bounds):
            row, column = np.repeat(np.arange(end - first), np.diff(bounds[first : end + 1])), place[term[part]]
            weight, on = self._weights(row, term[part], count[part], end - first), column >= 0
            dense[first + row[on], column[on]] = weight[on]
        dense /= np.maximum(np.sqrt((dense * dense).sum(axis=1, keepdims=True)), 1e-9)
        like = dense @ dense[np.linspace(0, n - 1, min(PIVOTS, n)).astype(int)].T
        centres = dense[:1]  # each further one is an example far from those before
        while len(centres) < min(CLUSTERS, n):
            centres = np.concatenate([centres, dense[[(dense @ centres.T).max(axis=1).argmin()]]])
        for _ in range(5):
            own = (dense @ centres.T).argmax(axis=1)
            centres = np.stack([dense[own == c].sum(axis=0) for c in range(len(centres))])
            centres /= np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-9)
        sizes = np.bincount(own)
        return np.lexsort((-like.max(axis=1), like.argmax(axis=1), own)), np.concatenate([[0], np.cumsum(sizes[sizes > 0])])

    def _post(self, row) -> None:
        """For each cluster the columns of its common terms, and their greatest weights by block; sparse
        postings by term of all else."""
        self.column = np.full((len(self.starts) - 1, len(self.terms)), -1, np.int16)
        self.dense, self.peaks, sparse = [], [], []
        for own, first, end in zip(self.column, self.starts[:-1], self.starts[1:]):
            a, b = self.bounds[first], self.bounds[end]
            term = self.term[a:b]
            found = np.bincount(term, minlength=len(self.terms))
            common = np.flatnonzero(found * COMMON >= end - first)
            common = common[np.argsort(-found[common], kind="stable")[:COMMON_TERMS]]
            own[common] = np.arange(len(common))
            place = own[term]
            on = place >= 0
            dense = np.zeros((end - first, len(common)), np.float32)
            dense[row[a:b][on] - first, place[on]] = self.weight[a:b][on]
            self.dense.append(dense)
            self.peaks.append(np.maximum.reduceat(dense, np.arange(0, len(dense), BLOCK), axis=0).T.copy())
            sparse.append(a + np.flatnonzero(~on))
        sparse = np.concatenate([np.empty(0, np.int64), *sparse])
        sparse = sparse[np.argsort(self.term[sparse], kind="stable")]
        self.posts = np.empty(len(sparse), [("at", np.int32), ("weight", np.float32)])
        self.posts["at"], self.posts["weight"] = row[sparse], self.weight[sparse]
        self.size = np.bincount(self.term[sparse], minlength=len(self.terms))
        self.begin = np.cumsum(self.size) - self.size

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of an example."""
        self._unfold()
        a, b = self.bounds[i], self.bounds[i + 1]
        return self.term[a:b], self.weight[a:b]

    def numbers(self, some: pa.LargeStringArray) -> np.ndarray:
        """A row for each word: the numbers of its three terms, -1 for those that no example has."""
        if not len(self.terms):
            return np.full((len(some), 3), -1)
        size, mark, no_term = pc.utf8_length(some), pa.scalar("*", some.type), pa.scalar(NO_TERM, some.type)
        short = (  # as `terms_of_word` has them
            pc.if_else(
                pc.greater(size, n), pc.binary_join_element_wise(pc.utf8_slice_codeunits(some, 0, n), mark, no_term), no_term
            )
            for n in (4, 5)
        )
        terms = pa.concat_arrays([some, *short]).dictionary_encode()  # words share their beginnings
        wanted = np.fromiter(map(hashed, terms.dictionary.to_numpy(False)), np.uint64, len(terms.dictionary))
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[at] == wanted, self.number[at], -1)[terms.indices.to_numpy()].reshape(3, -1).T

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(term numbers, weights) of unit length of each text; None without any known term."""
        some, text, word, count = words_of_all(texts)
        number = self.numbers(some)[word]
        known, many = number >= 0, max(1, len(self.terms))
        pair, place = np.unique((text[:, None] * many + number)[known], return_inverse=True)
        text, ids = np.divmod(pair, many)
        weights = (1 + np.log(np.bincount(place, np.broadcast_to(count[:, None], known.shape)[known]))) * self.idf[ids]
        cuts = pairwise(np.searchsorted(text, np.arange(len(texts) + 1)).tolist())
        return [(ids[a:b], weights[a:b] / np.sqrt((weights[a:b] ** 2).sum())) if a < b else None for a, b in cuts]

    def vector_of(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        return self.vectors([text])[0]

    def nearest(self, vector, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and similarities of the k nearest examples with similarity above 0, and how many
        examples were opened. Examples of the fold `without` take no part."""
        return next(self.all_nearest([vector], k, [without]))

    def all_nearest(self, vectors, k: int, without=None):
        """`nearest` of each vector."""
        self._unfold()
        for first in range(0, len(vectors), AT_ONCE):
            some = vectors[first : first + AT_ONCE]
            yield from self._together(some, k, without[first : first + AT_ONCE] if without is not None else None)

    def _together(self, vectors, k: int, without):
        n, many = len(self.docs), len(vectors)
        text = np.repeat(np.arange(many), [len(ids) for ids, _ in vectors])
        ids, weights = (np.concatenate(x) for x in zip(*vectors))
        sparse = np.empty((many, n), np.float32)
        for i, (some, theirs) in enumerate(vectors):
            size = self.size[some]
            posts = self.posts.take(_ranges(self.begin[some], size))
            sparse[i] = np.bincount(posts["at"], np.repeat(theirs, size) * posts["weight"], n)
        common, bound = [], sparse.copy()
        for column, peaks, first, end in zip(self.column, self.peaks, self.starts[:-1], self.starts[1:]):
            place = column[ids]
            on = place >= 0
            common.append(np.zeros((many, len(peaks)), np.float32))
            common[-1][text[on], place[on]] = weights[on]
            bound[:, first:end] += np.repeat(common[-1] @ peaks, BLOCK, axis=1)[:, : end - first]
        if without is not None:
            bound[self.fold == np.asarray(without)[:, None]] = -1
        greatest = np.maximum.reduceat(bound, self.starts[:-1], axis=1)
        least = np.zeros(many)
        opened: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in vectors]

        def open_cluster(c: int, some: np.ndarray) -> None:
            first, end = self.starts[c : c + 2]
            score = common[c][some] @ self.dense[c].T + sparse[some, first:end]
            score[bound[some, first:end] < 0] = -1
            bound[some, first:end] = -1
            best = np.partition(score, -k, axis=1)[:, -k] if end - first >= k else np.zeros(len(some))
            least[some] = np.maximum(least[some], best - SLACK)
            for i, scores in zip(some.tolist(), score):
                may = np.flatnonzero(scores >= least[i])
                opened[i].append((first + may, scores[may]))

        lead = greatest.argmax(axis=1)
        for c in range(len(self.dense)):
            some = np.flatnonzero(lead == c)
            if len(some) >= TOGETHER:
                open_cluster(c, some)
        for c, (first, end) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            some = np.flatnonzero((greatest[:, c] >= least - SLACK) & (greatest[:, c] > 0))
            closed = (bound[some, first:end] >= least[some, None] - SLACK).sum(axis=1)
            some = some[closed * PRODUCT > end - first]
            if len(some) >= TOGETHER:
                open_cluster(c, some)
        for i, (ids, weights) in enumerate(vectors):
            yield self._nearest(ids, weights, [x[i] for x in common], sparse[i], bound[i], opened[i], least[i], k)

    def _nearest(self, ids, weights, common, sparse, bound, opened, least: float, k: int):
        """What is left of a text's search: examples whose bound is above 0 are still closed."""
        rows, score = (np.concatenate(x) for x in zip((np.empty(0, np.int64), np.empty(0)), *opened))
        seen = int((bound < 0).sum()) if opened else 0
        wave, closed = OPENED, np.flatnonzero((bound > 0) & (bound >= least - SLACK))
        while len(closed):
            upper = bound[closed]
            if len(closed) > wave:
                part = np.argpartition(-upper, wave)
                new, closed = closed[part[:wave]], closed[part[wave:]]
            else:
                new, closed = closed, closed[:0]
            new = np.sort(new)
            found, cut = sparse[new], np.searchsorted(new, self.starts)
            for c in np.flatnonzero(np.diff(cut)):
                found[cut[c] : cut[c + 1]] += self.dense[c][new[cut[c] : cut[c + 1]] - self.starts[c]] @ common[c]
            rows, score, seen = np.concatenate([rows, new]), np.concatenate([score, found]), seen + len(new)
            if len(score) >= k:
                least = max(least, np.partition(score, len(score) - k)[len(score) - k] - SLACK)
            closed = closed[bound[closed] >= least - SLACK]
            wave *= 2
        near = rows[score >= least]
        exact = np.round(self._scores(near, self._spread(ids, weights)), 12)
        self._query[ids] = 0
        near, exact = near[exact > 0], exact[exact > 0]
        keep = np.lexsort((self.docs[near], -exact))[:k]
        return near[keep], exact[keep], seen

    def _spread(self, ids, weights) -> np.ndarray:
        """The weights by term number, in an array that is kept between texts and is 0 elsewhere."""
        self._query[ids] = weights
        return self._query

    def _scores(self, rows, query) -> np.ndarray:
        if not len(rows):
            return np.empty(0)
        ends = zip(self.bounds[rows].tolist(), self.bounds[rows + 1].tolist())
        return np.array([query.take(self.term[a:b]) @ self.weight[a:b] for a, b in ends])

    def vote(self, at: np.ndarray, similarity: np.ndarray) -> float:
        """Share of toxic examples among the nearest, weighted by similarity, drawn to the blank rate."""
        return float(((similarity * self.labels[at]).sum() + PULL * self.blank_score) / (similarity.sum() + PULL))

    def votes(self, some) -> np.ndarray:
        """The votes of these examples, each found by the other folds."""
        vectors = [self.row(i) for i in some]
        return np.array([self.vote(at, near) for at, near, _ in self.all_nearest(vectors, self.k, self.fold[list(some)])])

    def score(self, vector) -> tuple[float, list[tuple[int, int, float]]]:
        """Score and evidence: (doc_id, label, similarity) of the three nearest."""
        return self.all_scores([vector])[0]

    def all_scores(self, vectors) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """`score` of each vector."""
        found = self.all_nearest([v for v in vectors if v is not None], self.k)
        return [(self.blank_score, []) if v is None else self._score(*next(found)[:2]) for v in vectors]

    def _score(self, at, similarity) -> tuple[float, list[tuple[int, int, float]]]:
        value = float(np.interp(self.vote(at, similarity), *self.knots)) if len(at) else self.blank_score
        evidence = [
            (int(self.docs[i]), int(self.labels[i]), float(s)) for i, s in zip(at[:3].tolist(), similarity[:3].tolist())
        ]
        return min(1.0, max(0.0, value)), evidence


def calibration(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of labels on votes, as knots."""
    if not len(votes):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # sum of labels, count, sum of votes
    for v, label in zip(votes[order].tolist(), labels[order].tolist()):
        pools.append([label, 1.0, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    x = np.array([p[2] / p[1] for p in pools])
    y = np.array([(p[0] + 0.5) / (p[1] + 1.0) for p in pools])
    return np.concatenate([[0.0], x, [1.0]]), np.maximum.accumulate(np.concatenate([[y[0] * 0.5], y, [max(y[-1], 0.99)]]))


def likelihood_ratio(a: np.ndarray, b: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """G-squared of term and label: a toxic and b clean examples with the term; toxic, clean examples in all."""
    n, with_term = toxic + clean, a + b

    def part(seen, rows, columns):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) * n / np.maximum(rows * columns, 1)), 0.0)

    without = n - with_term
    return np.maximum(0.0, 2 * (
        part(a, with_term, toxic) + part(b, with_term, clean)
        + part(toxic - a, without, toxic) + part(clean - b, without, clean)
    ))


def learn(
    docs: DataFrame, labels: DataFrame, space: Workspace, max_examples: int = MAX_EXAMPLES, neighbours: int = NEIGHBOURS
) -> Index:
    """The index of the labelled texts. Examples are chosen by ids and digests, and texts become hashes
    and counts of terms where they lie, so no task or driver sees many whole texts."""
    known = (
        required(labels, "doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
        .filter(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    )
    texts = required(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"),
    )
    found = space.put("known", texts.join(F.broadcast(known), "doc_id").select(
        "doc_id", "label", F.sha2("text", 256).alias("digest")
    ))
    chosen = space.put("chosen", found.groupBy("digest").agg(
        F.max("label").alias("label"), F.min("doc_id").alias("doc_id")
    ).orderBy("digest").limit(max_examples))
    examples = (
        texts.join(F.broadcast(chosen), "doc_id").filter(F.sha2("text", 256) == F.col("digest"))
        .select("doc_id", "label", "text").mapInArrow(_example_terms, _TERMS)
    )
    # repeated rows give equal terms in equal order
    rows = space.put("examples", examples).distinct().toArrow()
    return Index(
        rows["doc_id"].to_numpy(), rows["label"].to_numpy(),
        _unpacked(rows["hashes"], np.uint64), _unpacked(rows["counts"], np.int32), neighbours, calibrate=False,
    )


def _voter(index):
    def run(batches):
        for batch in batches:
            votes = index.value.votes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.float64())], names=["at", "vote"])

    return run


def _calibrated(spark: SparkSession, index: Index, shared) -> tuple[np.ndarray, np.ndarray]:
    """The calibration; the examples are searched in tasks, so the driver needs no weights or postings."""
    n = len(index.docs)
    if not n:
        return index.knots
    found = spark.range(n).mapInArrow(_voter(shared), "at long, vote double").toArrow()
    votes = np.empty(n)
    votes[found["at"].to_numpy()] = found["vote"].to_numpy()
    return calibration(votes, index.labels)


def _some(texts: list[str]):
    """The texts in lists of at most `LETTERS_AT_ONCE` letters, or of one text."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > LETTERS_AT_ONCE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _scorer(index, knots):
    names = ["doc", "score", "evidence"]
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("similarity", pa.float64())]))

    def run(batches):
        model: Index = index.value
        model.knots = knots
        for batch in batches:
            found = [x for part in _some(batch.column(1).to_pylist()) for x in model.all_scores(model.vectors(part))]
            scores = [value for value, _ in found]
            evidence = [[{"doc_id": d, "label": y, "similarity": s} for d, y, s in near] for _, near in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=names
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence)."""
    spark = docs.sparkSession
    prepare(spark)
    index = learn(docs, labels, Workspace(spark, "toxicity"), max_examples)
    rows = required(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc"), whole_text().alias("text"))
    shared = spark.sparkContext.broadcast(index)
    scored = rows.mapInArrow(
        _scorer(shared, _calibrated(spark, index, shared)),
        "doc long, score double, evidence array<struct<doc_id:long,label:int,similarity:double>>",
    )
    return scored.select(
        F.col("doc").alias("doc_id"), held_out(F.col("doc")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence",
    )
