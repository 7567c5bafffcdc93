"""Operator 12: periodic runs of words, by suffix-tree longest extensions.

A run is a stretch of words with smallest period q that no neighbouring word
extends.  Every run of exponent 2 or more has a Lyndon root: the longest
Lyndon word starting at some position, under the order of words or its
inverse.  So each position gives two candidate roots, and a candidate is
extended to both sides by two longest-common-extension queries, one on the
suffix tree of the words and one on that of their reversal.  The trees are
built by Ukkonen's method; a query is a lowest common ancestor, read as the
minimum string depth on the Euler tour in constant time.

Only stretches that can hold a reported run get a tree: in a run of at least
``MIN_EXPONENT`` periods every three words in a row occur three times or more,
so a text is cut, exactly, at triples that are rarer in their piece.

Each text is one unit of work, whole; texts are independent rows, so the job
is one narrow stage without a shuffle, and a lost task repeats its own texts.

Defined results: a null or empty text, or one of spaces only, has no words, no
runs and an empty collapsed text.  Words are compared by their bytes.  A null
id is kept as it is.  Repeated rows give a row each.  Ties of the longest run:
smallest start, then smallest period.  Very long texts take memory in
proportion to their longest piece.  An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casekit.llm.common import prepare, table

MIN_WORDS = 6
MIN_EXPONENT = 4
WORD = r"[^\\x20\\x09-\\x0D]+"
_BLOCK = 8  # tour entries a block of the minimum table


class SuffixTree:
    """Suffix tree of the integers ``s`` (each at least 1), an end mark 0 added.

    ``rank`` and ``inverse_rank`` order the suffixes by the words and by the
    inverse order (a suffix that is a prefix of another comes first in both).
    """

    def __init__(self, s: np.ndarray) -> None:
        self.n = len(s)
        self._sigma = int(s.max(initial=0)) + 1
        self._build([*s.tolist(), 0])
        self._tour()

    def _build(self, s: list[int]) -> None:
        """Ukkonen's construction; a node's edge label is s[lo[v]:hi[v]]."""
        sigma, end = self._sigma, len(s)
        lo, hi, link, child = [0], [0], [0], {}
        node, edge, length, pending = 0, 0, 0, 0
        for i, c in enumerate(s):
            pending += 1
            last = 0
            while pending:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                nxt = child.get(key)
                if nxt is None:
                    child[key] = len(lo)
                    lo.append(i)
                    hi.append(end)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    span = (hi[nxt] if hi[nxt] < i + 1 else i + 1) - lo[nxt]
                    if length >= span:
                        edge += span
                        length -= span
                        node = nxt
                        continue
                    if s[lo[nxt] + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    mid = len(lo)
                    child[key] = mid
                    cut = lo[nxt] + length
                    lo += [lo[nxt], i]
                    hi += [cut, end]
                    link += [0, 0]
                    child[mid * sigma + c] = mid + 1
                    lo[nxt] = cut
                    child[mid * sigma + s[cut]] = nxt
                    if last:
                        link[last] = mid
                    last = mid
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self._edge = np.array(hi) - np.array(lo)
        keys = np.sort(np.fromiter(child.keys(), np.int64, len(child)))
        self._kids = np.fromiter(map(child.__getitem__, keys.tolist()), np.int64, len(keys))
        self._from = np.searchsorted(keys, np.arange(len(lo) + 1, dtype=np.int64) * sigma)
        self._marked = keys % sigma == 0  # edges that begin with the end mark

    def _tour(self) -> None:
        """Euler tour of string depths, each leaf's place on it, suffix ranks."""
        kids, at, edge = self._kids.tolist(), self._from.tolist(), self._edge.tolist()
        size, total = len(edge), self.n + 1
        depth = [0] * size
        tour: list[int] = []
        first = [0] * total
        order: list[int] = []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at a node between two children
                tour.append(depth[~v])
                continue
            d = depth[v]
            a, b = at[v], at[v + 1]
            if a == b:
                first[total - d] = len(tour)
                order.append(total - d)
                tour.append(d)
                continue
            tour.append(d)
            for k in range(b - 1, a - 1, -1):
                u = kids[k]
                depth[u] = d + edge[u]
                stack.append(u)
                if k > a:
                    stack.append(~v)
        self._first = np.array(first)
        self.rank = np.empty(total, np.int64)
        self.rank[order] = np.arange(total)
        # The inverse order keeps the end mark first and reads the others
        # backwards.
        order.clear()
        marked = self._marked.tolist()
        stack = [0]
        while stack:
            v = stack.pop()
            a, b = at[v], at[v + 1]
            if a == b:
                order.append(total - depth[v])
            elif marked[a]:
                stack += kids[a + 1:b]
                stack.append(kids[a])
            else:
                stack += kids[a:b]
        self.inverse_rank = np.empty(total, np.int64)
        self.inverse_rank[order] = np.arange(total)
        self._minima(np.array(tour, dtype=np.int64))

    def _minima(self, tour: np.ndarray) -> None:
        """Block minima with doubling, and running minima inside the blocks."""
        pad = -len(tour) % _BLOCK
        grid = np.concatenate([tour, np.full(pad, self.n + 2)]).reshape(-1, _BLOCK)
        self._flat = grid.ravel()
        self._up = np.minimum.accumulate(grid, axis=1).ravel()
        self._down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        levels = [grid.min(axis=1)]
        while len(levels[-1]) > (step := 1 << (len(levels) - 1)):
            levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        self._levels = levels

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j (i != j)."""
        a, b = self._first[i], self._first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        x, y = a // _BLOCK, b // _BLOCK
        out = np.minimum(self._down[a], self._up[b])
        near = x == y
        if near.any():
            here = self._flat[a[near]]
            for k in range(1, _BLOCK):
                here = np.minimum(here, self._flat[np.minimum(a[near] + k, b[near])])
            out[near] = here
        far = np.flatnonzero(y - x > 1)
        p, width = x[far] + 1, y[far] - x[far] - 1
        level = np.frexp(width)[1] - 1
        for k in np.unique(level):
            at = level == k
            got = np.minimum(self._levels[k][p[at]], self._levels[k][p[at] + width[at] - (1 << int(k))])
            out[far[at]] = np.minimum(out[far[at]], got)
        return out


def _roots(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position: the distance to the
    next smaller suffix (the empty one, ranked first, is the last)."""
    r = rank.tolist()
    out = [0] * (len(r) - 1)
    stack: list[int] = [len(r) - 1]
    for i in range(len(r) - 2, -1, -1):
        while r[stack[-1]] > r[i]:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out, dtype=np.int64)


def all_runs(s: np.ndarray) -> np.ndarray:
    """Every run of exponent 2 or more of ``s``, as rows (start, length, period)
    by start, then period."""
    n = len(s)
    if n < 2:
        return np.empty((0, 3), np.int64)
    _, codes = np.unique(s, return_inverse=True)
    codes = codes + 1
    ahead, back = SuffixTree(codes), SuffixTree(codes[::-1])
    found = []
    for rank in (ahead.rank, ahead.inverse_rank):
        period = _roots(rank)
        i = np.flatnonzero(np.arange(n) + period < n)
        p = period[i]
        after = ahead.common(i, i + p)
        before = np.zeros(len(i), np.int64)
        inner = i > 0
        before[inner] = back.common(n - i[inner], n - i[inner] - p[inner])
        length = before + p + after
        good = length >= 2 * p
        found.append(np.stack([i - before, length, p], axis=1)[good])
    return np.unique(np.concatenate(found), axis=0)[:, [0, 1, 2]]


def pieces(s: np.ndarray, least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Stretches of ``s`` that can hold runs of exponent 4, as (start, end).

    In such a run, of ``least`` >= 6 words, each triple of neighbours occurs
    three times at least; a run and any word that extends it therefore lie in
    one piece.  Counting again inside the pieces cuts further, until nothing
    changes.
    """
    n = len(s)
    if n < least:
        return []
    _, code = np.unique(s, return_inverse=True)
    size = int(code.max()) + 1
    pair = code[:-1].astype(np.int64) * size + code[1:]
    _, pair = np.unique(pair, return_inverse=True)
    triple = pair[:-1].astype(np.int64) * size + code[2:]
    where = np.arange(len(triple))
    group = np.zeros(len(triple), np.int64)
    while len(where):
        _, triple = np.unique(triple, return_inverse=True)
        _, inverse, count = np.unique(
            group * (int(triple.max()) + 1) + triple, return_inverse=True, return_counts=True)
        keep = count[inverse] >= 3
        kept = where[keep]
        if not len(kept):
            return []
        label = np.concatenate([[0], np.cumsum(np.diff(kept) > 1)])
        long = np.bincount(label)[label] >= least - 2
        if keep.all() and long.all():
            break
        where, group, triple = kept[long], label[long], triple[keep][long]
    if not len(where):
        return []
    ends = np.flatnonzero(np.diff(where) > 1)
    first = where[np.concatenate([[0], ends + 1])]
    last = where[np.concatenate([ends, [len(where) - 1]])]
    return [(int(a), int(b) + 3) for a, b in zip(first, last)]


def long_runs(s: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Runs with length >= max(least, 4 * period), by start, then period."""
    found = [np.empty((0, 3), np.int64)]
    for a, b in pieces(s, least):
        r = all_runs(s[a:b])
        r = r[r[:, 1] >= np.maximum(least, MIN_EXPONENT * r[:, 2])]
        found.append(r + [a, 0, 0])
    return np.concatenate(found)


def _encoded(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed).

    ``collapsed`` is the text without the words a run repeats after its first
    period, the others joined by one space.
    """
    if least < MIN_WORDS:
        raise ValueError(f"least must be {MIN_WORDS} or more")
    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"cast(`{text_col}` as binary) AS body")
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words bigint, "
              "runs array<struct<start bigint, length bigint, period bigint>>, collapsed string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, runs, collapsed = [], [], []
            for body in batch.column("body"):
                words = (body.as_py() or b"").split()  # ASCII white space
                found = long_runs(_encoded(words), least)
                if len(found):
                    keep = np.ones(len(words), bool)
                    for start, length, period in found.tolist():
                        keep[start + period:start + length] = False
                    words_kept = [words[i] for i in np.flatnonzero(keep)]
                else:
                    words_kept = words
                n_words.append(len(words))
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in found.tolist()])
                collapsed.append(b" ".join(words_kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()),
                 pa.array(runs, pa.list_(item)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(search, schema)


def planted(docs: DataFrame) -> DataFrame:
    """The contract's texts: a tenth of the documents made periodic from a word
    on, by the checksum of the id (a null id: as it is)."""
    cut = (
        docs.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id as string) as binary)) AS h")
        .withColumn("words", F.expr(
            f"if(h % 10 = 0, regexp_extract_all(text, '{WORD}', 0), cast(null as array<string>))"))
        .selectExpr("*", "size(words) AS n", "cast(floor(h / 10) as bigint) AS g")
        .selectExpr("*", "cast(if(n > 0, g % n, 0) as int) AS a")
        .selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) as int) AS p")
    )
    return cut.selectExpr(
        "doc_id",
        "if(n > 0, array_join(transform(words, (w, i) -> "
        "if(i < a, w, words[a + (i - a) % p])), ' '), text) AS text")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Contract query: runs of every document, some of them made periodic."""
    prepare(spark)
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    # Longest first, then smallest start, then smallest period.
    best = ("array_min(transform(runs, r -> struct(-r.length AS length, r.start AS start, r.period AS period)))")
    return (
        found.withColumn("best", F.expr(best))
        .selectExpr(
            "doc_id", "cast(size(runs) as bigint) AS n_runs", "best.start AS start",
            "-best.length AS length", "best.period AS period",
            "cast(-1000 * best.length div best.period as bigint) AS exponent_milli",
            "sha2(cast(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
            " as binary), 256) AS runs_sha256",
            "sha2(cast(collapsed as binary), 256) AS collapsed_sha256", "n_words")
    )
