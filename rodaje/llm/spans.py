"""Long exact spans shared between records, by relative Lempel-Ziv parsing against an index of all texts.

A text is written as factors, each the longest string that also stands in a reference. The reference is the corpus itself, in
blocks. To parse every text against every block would cost the square of the corpus, so blocks are formed by anchors: winnowing takes
the least hash of the k-grams of each window of `span` characters, equal windows have equal least hashes, and
so all windows that could match are in the block of that hash. Each text is cut into pieces, one per chosen gram, whose windows are exactly
those it was chosen for; a piece whose hash no other text has cannot hold a long factor and goes no further. Of equal pieces, as of equal texts,
one is parsed. A block is indexed by the suffix array of its pieces; a piece is factored greedily against what the
block holds of other texts, factors of at least `span` characters are spans, and at the boundaries between factors the windows that
reach over are looked up, since a span may begin in one factor and end in the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.session import cut

#: Window starts handled at once; bounds a worker's memory whatever a text's length.
_STARTS = 1 << 19

#: Pairs of pieces listed at once.
_PAIRS = 1 << 21


def _select(chars: np.ndarray, ends: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and hash of each chosen gram in concatenated texts; `ends` are the texts' ends.

    Every text has at least k + w - 1 characters. A gram serves the windows from the first one not yet served to
    the last one in a row that holds it as a least one; of equal least grams the last in the window is chosen.
    """
    n = len(chars)
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    power = np.full(n, base, dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    back = np.full(n - k + 1, inverse, dtype=np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    h = (sums[k:] - sums[:-k]) * back
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # Least hash of each window of w grams: minima of prefixes and suffixes of blocks of w.
    m = len(h)
    pad = -m % w
    blocks = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, w)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = m - w + 1
    least = np.minimum(suffix[:starts], prefix[w - 1 : w - 1 + starts])
    # A window counts if it lies in one text.
    ok = np.zeros(starts + 1, dtype=np.int8)
    first = np.concatenate([[0], ends[:-1]])
    np.add.at(ok, first, 1)
    np.add.at(ok, ends - (k + w - 1) + 1, -1)
    inside = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
    lows = least[inside]
    runs = np.flatnonzero(np.concatenate([[True], (lows[1:] != lows[:-1]) | (inside[1:] != inside[:-1] + 1)]))
    begin, last = inside[runs], inside[np.concatenate([runs[1:], [len(inside)]]) - 1]
    value = lows[runs]
    served, upto, found = [], [], []
    while len(begin):
        at = _last_equal(h, begin, value, w)
        stop = np.minimum(at, last)
        served.append(begin), upto.append(stop), found.append(value)
        more = stop < last
        begin, last, value = stop[more] + 1, last[more], value[more]
    begin = np.concatenate(served)
    order = np.argsort(begin)
    return begin[order], (np.concatenate(upto) - begin + 1)[order], np.concatenate(found)[order]


def _last_equal(h: np.ndarray, start: np.ndarray, value: np.ndarray, w: int) -> np.ndarray:
    out = np.empty(len(start), dtype=np.int64)
    step = max(1, (1 << 22) // w)
    for i in range(0, len(start), step):
        s = start[i : i + step]
        idx = np.minimum(s[:, None] + np.arange(w - 1, -1, -1), len(h) - 1)
        out[i : i + step] = s + w - 1 - (h[idx] == value[i : i + step, None]).argmax(axis=1)
    return out


def _chosen(texts: Iterator[tuple[int, str]], k: int, w: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """tag, pos, n, fp of the chosen grams of tagged texts, for about _STARTS characters at a time; a longer text goes on in the next lot."""
    span = k + w - 1
    tags: list[int] = []
    offsets: list[int] = []
    parts: list[str] = []
    held = 0

    def lot() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        ends = np.cumsum(sizes)
        at, n, fp = _select(np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32), ends, k, w)
        of = np.searchsorted(ends, at, side="right")
        pos = at - (ends - sizes)[of] + np.asarray(offsets, dtype=np.int64)[of]
        found = np.asarray(tags, dtype=np.int64)[of], pos, n, fp.view(np.int64)
        tags.clear(), offsets.clear(), parts.clear()
        return found

    for tag, text in texts:
        for start in range(0, len(text) - span + 1, _STARTS):
            part = text[start : start + _STARTS + span - 1]
            tags.append(tag), offsets.append(start), parts.append(part)
            held += len(part)
            if held >= _STARTS:
                yield lot()
                held = 0
    if parts:
        yield lot()


def _anchor_batches(k: int, w: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for doc, _, _, fp in _chosen(rows, k, w):
            order = np.lexsort((fp, doc))
            doc, fp = doc[order], fp[order]
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])])
            yield pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(fp[new])], names=["doc", "fp"])

    return run


def _long_enough(docs: DataFrame, id_col: str, text_col: str, span: int) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(
        F.col("doc").isNotNull() & (F.length("text") >= span)
    )


def anchors(docs: DataFrame, id_col: str, text_col: str, span: int = 150, k: int = 80) -> DataFrame:
    """doc, fp: the hashes of the chosen grams of each text of at least `span` characters. Null, empty and shorter texts have none."""
    return _long_enough(docs, id_col, text_col, span).mapInArrow(_anchor_batches(k, span - k + 1), "doc long, fp long")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 150) -> DataFrame:
    """doc, rep, n: the records whose text another record has as well, with the least id of those and their number.

    Texts are compared by 128 bits of hash. Texts shorter than `span`, null and empty ones are left out.
    """
    keys = _long_enough(docs, id_col, text_col, span).select(
        "doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")
    ).repartition("h1", "h2").distinct()
    groups = keys.groupBy("h1", "h2").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(groups, ["h1", "h2"]).select("doc", "rep", "n")


def _cut_pieces(span: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per piece of a text whose hash is asked for: its windows, led by the character before them (an empty one where the text begins)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc": pa.int64(), "pos": pa.int32(), "fp": pa.int64(), "many": pa.bool_(), "head": pa.bool_(), "text": pa.string()}
        out: dict[str, list] = {c: [] for c in kinds}
        open_: dict[int, tuple] = {}  # texts in the lot
        held = 0

        def rows() -> Iterator[tuple[int, str]]:
            tag = 0
            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in ("doc", "text", "many", "fps"))):
                    open_[tag] = row
                    yield tag, row[1]
                    tag += 1

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in out.items()], names=list(out))
            for v in out.values():
                v.clear()
            return batch

        for tag, pos, n, fp in _chosen(rows(), k, span - k + 1):
            edge = np.flatnonzero(np.concatenate([[True], tag[1:] != tag[:-1]]))
            for a, b in zip(edge, [*edge[1:], len(tag)]):
                doc, text, many, fps = open_[int(tag[a])]
                for i in a + np.flatnonzero(np.isin(fp[a:b], fps)):
                    at = int(pos[i])
                    piece = (text[at - 1] if at else "\x00") + text[at : at + int(n[i]) + span - 1]
                    for c, v in zip(out, (doc, at, int(fp[i]), many, at == 0, piece)):
                        out[c].append(v)
                    held += len(piece)
                    if held >= _STARTS:
                        yield flush()
                        held = 0
            last = int(tag[-1])
            for t in [t for t in open_ if t < last]:
                del open_[t]
        if held:
            yield flush()

    return run


def pieces(docs: DataFrame, id_col: str, text_col: str, span: int, k: int, same: DataFrame) -> DataFrame:
    """doc, pos, fp, many, head, text, c1, c2: the pieces of texts whose hash stands in several texts.

    Of equal texts (`same`, made by `copies`) the least id speaks for all; many marks its pieces. c1 and c2 identify the
    piece's content. Hashes of one text only are dropped before any text is moved.
    """
    every = anchors(docs, id_col, text_col, span, k).where("fp is not null and doc is not null").repartition("fp")
    # Both uses read the same columns, so that the anchors are made and moved only once.
    shared = every.groupBy("fp").agg(F.min("doc").alias("_a"), F.max("doc").alias("_b")).where("_a < _b").select("fp")
    kept = every.join(shared, "fp").groupBy("doc").agg(F.collect_set("fp").alias("fps"))
    known = same.select("doc", "rep")
    kept = kept.join(known, "doc", "left").where("rep is null or rep = doc").select("doc", "fps", F.col("rep").isNotNull().alias("many"))
    texts = _long_enough(docs, id_col, text_col, span)
    # The grams of these texts are chosen once more, which costs less than moving the places of all.
    cut_up = kept.join(texts, "doc").select("doc", "text", "many", "fps").mapInArrow(
        _cut_pieces(span, k), "doc long, pos int, fp long, many boolean, head boolean, text string"
    )
    return cut_up.withColumns({"c1": F.xxhash64("fp", "head", "text"), "c2": F.xxhash64(F.lit(7), "text", "head")})


def _suffix_array(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes, and the common length of each with the one before it (0 for the first).

    Strings end in codes of their own and are shorter than `limit`, so that no two suffixes are equal for that long. Ranks by the first
    h codes give those by 2 h; they are kept to find common lengths by halving steps.
    """
    n = len(codes)
    bits = int(codes.max() + 2).bit_length()
    h = 1 << ((62 // bits).bit_length() - 1)
    padded = np.concatenate([codes + 1, np.zeros(h, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(h):
        key = (key << bits) | padded[i : n + i]
    ranks: list[tuple[int, np.ndarray]] = []
    while True:
        distinct, rank = np.unique(key, return_inverse=True)
        ranks.append((h, rank.astype(np.int32)))
        if len(distinct) == n or h >= limit:
            break
        key = rank.astype(np.int64) * (n + 1)
        key[: n - h] += rank[h:] + 1
        h *= 2
    order = np.argsort(ranks[-1][1], kind="stable")
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int64)
    top = n - 1
    for h, rank in reversed(ranks):
        common += h * (rank[np.minimum(a + common, top)] == rank[np.minimum(b + common, top)])
    step = ranks[0][0] // 2
    while step:
        same = np.ones(n - 1, dtype=bool)
        for i in range(step):
            same &= codes[np.minimum(a + common + i, top)] == codes[np.minimum(b + common + i, top)]
        common += step * same
        step //= 2
    return order, np.concatenate([[0], common])


def _longest_elsewhere(order: np.ndarray, common: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per position, the length of the longest match with a suffix of another owner: the nearer one in either direction."""
    n = len(order)
    own = owner[order]
    best = np.zeros(n, dtype=np.int64)
    for flip in (False, True):
        o = own[::-1] if flip else own
        c = np.concatenate([[0], common[:0:-1]]) if flip else common
        # The least common length since the owner changed: a step down by more than any length restarts the minimum.
        run = np.cumsum(np.concatenate([[0], o[1:] != o[:-1]])) * (1 << 32)
        low = np.minimum.accumulate(c - run) + run
        best = np.maximum(best, low[::-1] if flip else low)
    out = np.empty(n, dtype=np.int64)
    out[order] = best
    return out


def _factor_ends(longest: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the greedy factors of the strings [begin, end); a character without a match is a factor of its own."""
    starts, stops = [], []
    at, last = begin.copy(), end
    while len(at):
        stop = np.minimum(at + np.maximum(longest[at], 1), last)
        starts.append(at), stops.append(stop)
        live = stop < last
        at, last = stop[live], last[live]
    return (np.concatenate(starts), np.concatenate(stops)) if starts else (begin, end)


def _parsed(
    raw: np.ndarray, sizes: np.ndarray, head: np.ndarray, owner: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which windows of the concatenated pieces stand in another owner's, the codes of their characters, the suffix order and common lengths.

    sizes counts each piece's characters, the one before its windows and the mark after them included. Marks, and the empty
    places before a text's beginning (head), have codes of their own.
    """
    ends = np.cumsum(sizes)
    begin = ends - sizes
    codes = np.unique(raw, return_inverse=True)[1].astype(np.int64)
    for at in (ends - 1, begin[head]):
        codes[at] = codes.max() + 1 + np.arange(len(at))
    order, common = _suffix_array(codes, int(sizes.max()))
    longest = _longest_elsewhere(order, common, np.repeat(owner, sizes))
    starts, stops = _factor_ends(longest, begin + 1, ends - 1)
    # A window inside a factor is found with it.
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    long = stops - starts >= span
    np.add.at(change, starts[long], 1)
    np.add.at(change, stops[long] - span + 1, -1)
    inside = np.cumsum(change[:-1]) > 0
    # The windows that reach over a boundary begin less than a span before it.
    reach = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(reach, np.maximum(stops - span + 1, starts), 1)
    np.add.at(reach, stops, -1)
    over = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
    inside[over] |= longest[over] >= span
    return inside, codes, order, common


def _pair_chunks(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members of groups [first, first + size), as indices, in chunks."""
    for lo, n in zip(first, size):
        if n * n > _PAIRS:
            step = max(1, _PAIRS // n)
            for i in range(0, n, step):
                a, b = np.meshgrid(np.arange(i, min(i + step, n)), np.arange(n), indexing="ij")
                keep = a < b
                yield lo + a[keep], lo + b[keep]
    small = size * size <= _PAIRS
    first, size = first[small], size[small]
    bound = np.cumsum(size * size)
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(bound, (bound[i - 1] if i else 0) + _PAIRS, side="right")))
        s = size[i:j]
        member = np.repeat(first[i:j], s * s)
        k = np.arange(len(member)) - np.repeat(np.cumsum(s * s) - s * s, s * s)
        wide = np.repeat(s, s * s)
        a, b = k // wide, k % wide
        keep = a < b
        yield member[keep] + a[keep], member[keep] + b[keep]
        i = j


def _block_parse(span: int, pairs: bool) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        c1, c2, part, head = (table.column(c).to_numpy() for c in ("c1", "c2", "part", "head"))
        apart = table.column("b2").to_numpy() != table.column("b3").to_numpy()
        texts = table.column("text").to_pylist()
        n = len(texts)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=n) + 1
        begin = np.cumsum(sizes) - sizes
        raw = np.frombuffer("".join(t + "\x00" for t in texts).encode("utf-32-le"), dtype=np.uint32)
        # A piece of several texts has no owner: all of its windows stand in another one.
        several = table.column("owner").is_null().to_numpy(zero_copy_only=False)
        owner = np.unique(table.column("owner").fill_null(0).to_numpy(), return_inverse=True)[1].astype(np.int64)
        owner[several] = n + np.flatnonzero(several)
        inside, codes, order, common = _parsed(raw, sizes, head, owner, span)
        piece = np.repeat(np.arange(n), sizes)
        if not pairs:
            # The runs of windows that stand elsewhere, counted from the piece's first window.
            edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
            lo, hi = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) - 1
            alone = ~several[piece[lo]]
            lo, hi = lo[alone], hi[alone]
            at = np.concatenate([piece[lo], np.flatnonzero(several)])
            lo = np.concatenate([lo - begin[piece[lo]] - 1, np.zeros(several.sum(), dtype=np.int64)])
            hi = np.concatenate([hi - begin[piece[hi]] - 1, (sizes - span - 2)[several]])
            return pa.table({"c1": c1[at], "c2": c2[at], "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})
        # Equal windows are neighbours in the suffix array. If all follow one and the same character, the windows before them
        # are equal too, and the pair is found there.
        before = np.concatenate([[-1], codes[:-1]])[order]
        group = common < span
        first = np.flatnonzero(group)
        size = np.diff(np.concatenate([first, [len(order)]]))
        differ = np.minimum.reduceat(before, first) != np.maximum.reduceat(before, first)
        want = (size > 1) & differ & np.logical_or.reduceat(inside[order], first)
        found = [np.flatnonzero(head & several) * (n + 1)]
        for x, y in _pair_chunks(first[want], size[want]):
            ok = before[x] != before[y]
            a, b = piece[order[x[ok]]], piece[order[y[ok]]]
            ok = (owner[a] != owner[b]) & (~apart[a] | (part[a] != part[b]))
            a, b = a[ok], b[ok]
            found.append(np.unique(np.minimum(a, b) * n + np.maximum(a, b)))
        both = np.unique(np.concatenate(found))
        a, b = both // n, both % n
        return pa.table({"a1": c1[a], "a2": c2[a], "b1": c1[b], "b2": c2[b]})

    return run


def _blocks(of: DataFrame, fill: int) -> DataFrame:
    """The distinct contents of pieces, dealt to blocks of about `fill`; b1, b2, b3 name a block.

    Equal hashes are in one block. Contents of a hash with more than `fill` are dealt to parts, and each two parts are a block.
    """
    whole = of.groupBy("c1", "c2", "fp", "head").agg(
        F.first("text").alias("text"), F.min("doc").alias("_a"), F.max("doc").alias("_b"), F.max("many").alias("_m")
    )
    whole = cut(whole.select("c1", "c2", "fp", "head", "text", F.when((F.col("_a") == F.col("_b")) & ~F.col("_m"), F.col("_a")).alias("owner")))
    bins = max(1, -(-whole.count() // fill))
    crowded = whole.groupBy("fp").agg(F.ceil(F.count(F.lit(1)) / fill).cast("int").alias("parts")).where("parts > 1")
    dealt = whole.join(crowded, "fp", "left").withColumn("part", F.pmod(F.xxhash64("c1", "c2"), F.coalesce("parts", F.lit(1))).cast("int"))
    meets = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("_other", F.explode(meets))
    low, high = F.least("part", "_other"), F.greatest("part", "_other")
    return dealt.select(
        "c1", "c2", "head", "text", "owner", "part", F.when(F.col("_other") < 0, F.pmod("fp", F.lit(bins))).otherwise(F.col("fp")).alias("b1"),
        F.when(F.col("_other") < 0, -1).otherwise(low).alias("b2"), F.when(F.col("_other") < 0, -1).otherwise(high).alias("b3"),
    )


def _paired(docs: DataFrame, id_col: str, text_col: str, span: int, k: int, fill: int, same: DataFrame) -> DataFrame:
    """doc_a < doc_b: the pairs of different texts, given by their least ids."""
    parts = cut(pieces(docs, id_col, text_col, span, k, same))
    met = _blocks(parts, fill).groupBy("b1", "b2", "b3").applyInArrow(_block_parse(span, True), "a1 long, a2 long, b1 long, b2 long")
    of = lambda s: parts.select(F.col("c1").alias(f"{s}1"), F.col("c2").alias(f"{s}2"), F.col("doc").alias(f"_{s}")).distinct()
    pairs = met.distinct().join(of("a"), ["a1", "a2"]).join(of("b"), ["b1", "b2"]).where("_a <> _b")
    return pairs.select(F.least("_a", "_b").alias("doc_a"), F.greatest("_a", "_b").alias("doc_b")).distinct()


def shared_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 150, k: int = 80, fill: int = 5000
) -> DataFrame:
    """doc_a < doc_b: every pair of records with a passage of at least `span` characters in common.

    Equal texts are parsed once and their pairs written out at the end. Null, empty and short texts are in no pair; a row given
    twice counts once; ids are expected to be unique.
    """
    same = cut(copies(docs, id_col, text_col, span))
    pairs = _paired(docs, id_col, text_col, span, k, fill, same)
    one = lambda s: same.select(F.col("rep").alias(f"doc_{s}"), F.col("doc").alias(f"_{s}"))
    every = pairs.join(one("a"), "doc_a", "left").join(one("b"), "doc_b", "left").select(
        F.coalesce("_a", "doc_a").alias("a"), F.coalesce("_b", "doc_b").alias("b")
    )
    twins = same.select("rep", F.col("doc").alias("a")).join(same.select("rep", F.col("doc").alias("b")), "rep").where("a < b").select("a", "b")
    return every.unionByName(twins).select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b"))


def shared_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 150, k: int = 80, fill: int = 5000
) -> DataFrame:
    """doc, class, copies, links for every record: the least id of its text, how many records have it, and how many other texts share a passage.

    The form without pairs of copies: a class of n records adds n rows. A text that is short, empty or null is a class of its own.
    """
    same = cut(copies(docs, id_col, text_col, span))
    pairs = _paired(docs, id_col, text_col, span, k, fill, same)
    ends = pairs.select(F.explode(F.array("doc_a", "doc_b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("links"))
    every = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc")).distinct()
    known = every.join(same, "doc", "left").select("doc", F.coalesce("rep", "doc").alias("class"), F.coalesce("n", F.lit(1).cast("long")).alias("copies"))
    return known.join(ends, "class", "left").select("doc", "class", "copies", F.coalesce("links", F.lit(0).cast("long")).alias("links"))


def shared_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 150, k: int = 80, fill: int = 5000
) -> DataFrame:
    """doc, start, stop: the characters [start, stop) of a record that lie in passages of `span` or more found elsewhere.

    Spans of one record neither touch nor overlap. The work grows with the shared text and not with the pairs of records.
    """
    same = cut(copies(docs, id_col, text_col, span))
    parts = cut(pieces(docs, id_col, text_col, span, k, same))
    found = _blocks(parts, fill).groupBy("b1", "b2", "b3").applyInArrow(_block_parse(span, False), "c1 long, c2 long, lo int, hi int")
    factors = parts.where("not many").select("doc", "pos", "c1", "c2").join(found, ["c1", "c2"]).select(
        "doc", (F.col("pos") + F.col("lo")).alias("start"), (F.col("pos") + F.col("hi") + span).alias("stop")
    )
    whole = _long_enough(docs, id_col, text_col, span).select("doc", F.lit(0).alias("start"), F.length("text").alias("stop"))
    return _union_of_intervals(factors.unionByName(whole.join(same.select("doc"), "doc", "left_semi")))


def _union_of_intervals(spans: DataFrame) -> DataFrame:
    before = W.partitionBy("doc").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("doc").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, 0)
    spans = spans.groupBy("doc", "start").agg(F.max("stop").alias("stop"))
    fresh = F.coalesce(F.max("stop").over(before) < F.col("start"), F.lit(True)).cast("int")
    return (
        spans.withColumn("_new", fresh).withColumn("_g", F.sum("_new").over(upto))
        .groupBy("doc", "_g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_g")
    )


def shared_share(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 150, k: int = 80, fill: int = 5000
) -> DataFrame:
    """doc, n_chars, shared_chars, share for every record.

    share is 0 for a null or empty text, whose n_chars is 0. A row given twice counts once.
    """
    base = docs.groupBy(F.col(id_col).cast("long").alias("doc")).agg(
        F.coalesce(F.max(F.length(text_col)), F.lit(0)).cast("long").alias("n_chars")
    )
    found = shared_spans(docs, id_col, text_col, span, k, fill).groupBy("doc").agg(F.sum(F.col("stop") - F.col("start")).cast("long").alias("shared_chars"))
    shared = F.coalesce("shared_chars", F.lit(0).cast("long"))
    return base.join(found, "doc", "left").select(
        "doc", "n_chars", shared.alias("shared_chars"),
        F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0)).alias("share"),
    )
