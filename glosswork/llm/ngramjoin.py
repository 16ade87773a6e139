"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles. Two documents link when
``den * |A & B| >= num * |A | B|``; the result gives each document the smallest
id it reaches over links.

Method
1. Documents with equal sets are one class (a 128-bit hash of the set; a class goes by its first
   64 bits, and the few that share them get new ones). A count sketch, sized by the input, takes in
   every class's shingles. Its counts never fall below the true number of classes that hold a shingle.
2. Each class orders its shingles by (sketch count, hash). Similar classes share at
   least m of the first ``size - least overlap + m`` shingles, for every m. Longer
   prefixes cost more postings but let m, the matches required, grow: m is chosen
   for the smallest estimated cost, postings plus ``postings / m`` candidates (no more
   documents than that can have m matches) times the cost of verifying one.
3. Postings meet by shingle. A short list gives its pairs that pass the length and
   position filters; pairs with at least min(m, m') shared prefix shingles survive.
   A list longer than ``PAIR_LIST`` gives no pairs: its classes are tied to the
   shingle itself, so the cost stays linear. The matches required hold here too: a class
   whose prefix shares fewer shingles with others than the least m among it and
   those others has no partner, and its ties go.
4. Connected components over survivors and ties are blocks: every pair that can link
   lies in one block. The sets of a block are shipped to one task and verified exactly. A larger
   block goes in parts, each with the block's leaders: the classes whose prefixes are shared most.
   Parts and leaders merge into groups; since links inside a group add nothing, only classes outside
   the block's largest group are then verified against all of the block, in tiles. A group of near copies
   thus costs one pass, however large; what stays quadratic is the part of a block that no leader reaches.

Nothing is capped: long lists and large blocks take the other, exact way.

Defined results
* null or empty text, or text without words: no shingles, linked with nothing;
* fewer words than a shingle: the whole sequence is one shingle;
* a null id takes part; a component's id is its smallest non-null id (null if none);
* repeated rows are documents with equal sets; an empty table gives no rows;
* only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.llm.components import joined_components
from glosswork.llm.store import Scratch, ship_package
from glosswork.llm.tokens import mix, shingle_sets

#: Counters of one stored piece of the sketch, of the smallest and the largest sketch (powers of two), and bytes of input for each counter.
#: The largest is a broadcast of 32 MB. Where counters are shared, counts grow alike, so frequent shingles still come last.
SKETCH_PIECE, LEAST_SKETCH, MOST_SKETCH, COUNTER_BYTES = 1 << 16, 1 << 18, 1 << 24, 64
#: A count is kept in two bytes as its logarithm, in steps of 0.07 %, rounded up; small counts are exact.
STEPS_TO_DOUBLE = 1024
#: Lists up to this length give pairs, longer ones ties.
PAIR_LIST = 24
#: Lists whose sketch count is above this are dealt over several tasks; they give ties in any case.
SPLIT_LIST = 4096
#: Matches required at most.
MOST_MATCHES = 8
#: Verifying a candidate costs about so many postings.
VERIFY_COST = 12.0
#: A part of a large block holds about so many classes and shingles; so many leaders go with each.
TILE_CLASSES, TILE_SHINGLES, LEADERS = 64, 1_000_000, 16
#: Classes and shingles on either side of a tile of those that no leader reached.
REST_CLASSES, REST_SHINGLES = 128, 1_000_000
#: Bits of one piece of the filter for classes that occur in blocks, of the largest filter (16 MB), and bits for each class.
MEMBER_PIECE, MOST_BITS, CLASS_BITS = 1 << 18, 1 << 27, 16
#: Classes that share 64 bits of their hash: none are expected below 10**9 classes.
MOST_COLLISIONS = 10_000

_U = np.uint64


def least_overlap(size: int, num: int, den: int) -> int:
    """The least intersection of a set of ``size`` with any similar set."""
    return -(-num * size // den)


def pack_counts(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(STEPS_TO_DOUBLE * np.log2(1.0 + counts) - 1e-6), 65535).astype(np.uint16)


#: The count for each packed value, never below the one that was packed.
UNPACKED = np.floor(np.exp2(np.arange(65536) / STEPS_TO_DOUBLE) - 1.0 + 1e-6).clip(0, 2.0**62).astype(np.int64)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _set_hashes(own: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        one, two = mix(own).sum(dtype=np.uint64), mix(own ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        return int(mix(np.array([one ^ _U(len(own))]))[0].view(np.int64)), int(two.view(np.int64))


def sketch_width(docs: DataFrame) -> int:
    """A power of two by the size that the planner knows of the input; the least where it knows none."""
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = 1 << max(0, (known // COUNTER_BYTES).bit_length()) if known < 1 << 60 else 0
    return min(max(wanted, LEAST_SKETCH), MOST_SKETCH)


def class_of(own: np.ndarray, renamed: dict[tuple[int, int], int]) -> int:
    pair = _set_hashes(own)
    return renamed.get(pair, pair[0]) if renamed else pair[0]


CLASS_SCHEMA = "kind tinyint, doc_id long, n long, cls long, cls2 long, piece int, counts binary"


def _classes(n: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int8()), ("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("cls2", pa.int64()), ("piece", pa.int32()), ("counts", pa.binary())])
        counts, known = np.zeros(width, np.uint32), set()

        def count(waiting):
            at, times = np.unique(np.concatenate(waiting), return_counts=True)
            counts[at] += times.astype(np.uint32)

        for batch in batches:
            sizes, one, two = [], [], []
            waiting: list[np.ndarray] = []
            for _, own in shingle_sets(batch.column(1), n):
                a, b = _set_hashes(own) if len(own) else (0, 0)
                sizes.append(len(own))
                one.append(a)
                two.append(b)
                if len(own) and a not in known:
                    known.add(a)
                    waiting.append((own & _U(width - 1)).astype(np.int64))
                if len(waiting) >= 512:
                    count(waiting)
                    waiting = []
            if waiting:
                count(waiting)
            k = len(sizes)
            if k:
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(k, np.int8)), batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], schema=schema)
        if known:
            for i, row in enumerate(counts.reshape(-1, SKETCH_PIECE)):
                if row.any():
                    yield pa.RecordBatch.from_arrays([pa.array([1], pa.int8()), *[pa.nulls(1, pa.int64())] * 4, pa.array([i], pa.int32()), pa.array([zlib.compress(row.tobytes(), 1)], pa.binary())], schema=schema)

    return run


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(zlib.decompress(blob.as_py()), np.uint32).astype(np.uint64)
            total[piece] = total[piece] + own if piece in total else own
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack_counts(v).tobytes() for v in total.values()], pa.binary())], names=["piece", "counts"])


def choose_matches(est: np.ndarray, size: int, overlap: int) -> tuple[int, int]:
    """(matches required, prefix length) of the smallest estimated cost, given the ordered sketch counts."""
    base = size - overlap
    most = min(MOST_MATCHES, overlap)
    others = np.cumsum(est[: base + most].astype(np.float64) - 1.0)
    need = np.arange(1, most + 1)
    postings = others[base + need - 1]
    cost = (base + need) + postings * (1.0 + VERIFY_COST / need)
    m = int(np.argmin(cost)) + 1
    return m, base + m


POSTING_SCHEMA = "tok long, part int, cls long, info long"


def _postings(n: int, num: int, den: int, sketch, renamed):
    """info packs size (30 bits), position (30 bits) and matches (4 bits). part: of a list that is dealt over several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = sketch.value, set()
        for batch in batches:
            toks, parts, clss, infos, held = [], [], [], [], 0
            for _, own in shingle_sets(batch.column(0), n):
                size = len(own)
                if not size:
                    continue
                cls = class_of(own, renamed)
                if cls in known:
                    continue
                known.add(cls)
                est = UNPACKED[counts[(own & _U(len(counts) - 1)).astype(np.int64)]]
                overlap = least_overlap(size, num, den)
                reach = min(size, size - overlap + MOST_MATCHES)
                order = np.lexsort((own, est)) if reach >= size else _first(est, own, reach)
                est = est[order]
                m, length = choose_matches(est, size, overlap)
                # A count of 1 proves that no other class holds the shingle.
                at = np.flatnonzero(est[:length] > 1)
                if not len(at):
                    continue
                split = np.maximum(1, -(-est[at] // SPLIT_LIST))
                toks.append(own[order[at]])
                parts.append(np.where(split > 1, (cls & 0x7FFFFFFF) % np.minimum(split, 1 << 20), -1).astype(np.int32))
                clss.append(np.full(len(at), cls, np.int64))
                infos.append((size << 34) | (at << 4) | m)
                held += len(at)
                if held >= 200_000:
                    yield _posting_batch(toks, parts, clss, infos)
                    toks, parts, clss, infos, held = [], [], [], [], 0
            if held:
                yield _posting_batch(toks, parts, clss, infos)

    return run


def _first(est: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` smallest by (count, hash), in order; ``own`` is sorted, so a stable sort by count does."""
    return np.argsort(est, kind="stable")[:k]


def _posting_batch(toks, parts, clss, infos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(np.concatenate(toks)), pa.array(np.concatenate(parts)), pa.array(np.concatenate(clss)), pa.array(np.concatenate(infos).astype(np.int64))], names=["tok", "part", "cls", "info"])


CANDIDATE_SCHEMA = "a long, b long, need int"
_PAIRS = {k: np.triu_indices(k, 1) for k in range(2, PAIR_LIST + 1)}


def _candidates(num: int, den: int):
    """Postings sorted by (tok, part, cls) to pairs (a < b, need > 0), ties (b is the shingle's node, need 0) and, for each
    class and shingle that others share, a row (a = b) whose need is the least of the list's, or 1 where the list is not seen whole."""

    def short(cls, info, starts, lengths):
        for k in np.unique(lengths):
            at = starts[lengths == k][:, None] + np.arange(k)
            i, j = _PAIRS[int(k)]
            left, right = at[:, i].ravel(), at[:, j].ravel()
            a, b = cls[left], cls[right]
            sa, sb = info[left] >> 34, info[right] >> 34
            pa_, pb = (info[left] >> 4) & 0x3FFFFFFF, (info[right] >> 4) & 0x3FFFFFFF
            # |A & B| >= num / (num + den) * (|A| + |B|), and no more shingles can follow than the shorter rest.
            overlap = -(-num * (sa + sb) // (num + den))
            good = (den * np.minimum(sa, sb) >= num * np.maximum(sa, sb)) & (np.minimum(sa - pa_, sb - pb) + np.minimum(pa_, pb) >= overlap)
            a, b, need = a[good], b[good], np.minimum(info[left] & 15, info[right] & 15)[good]
            yield np.minimum(a, b), np.maximum(a, b), need

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the postings of the last list met, which may go on
        tied = None  # (tok, part) of a long list that goes on

        def made(blocks):
            blocks = [x for x in blocks if len(x[0])]
            if blocks:
                a, b, need = (np.concatenate(x) for x in zip(*blocks, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(need.astype(np.int32))], names=["a", "b", "need"])

        def tie(tok, cls):
            with np.errstate(over="ignore"):
                node = mix(tok.view(np.uint64) ^ _U(0xA0761D6478BD642F)).view(np.int64)
            return cls, node, np.zeros(len(cls), np.int64)

        def handle(tok, part, cls, info, last):
            nonlocal rest, tied
            # A class comes once from each partition that holds it.
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (part[1:] != part[:-1]) | (cls[1:] != cls[:-1])
            tok, part, cls, info = tok[new], part[new], cls[new], info[new]
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (part[1:] != part[:-1])
            starts = np.flatnonzero(new)
            lengths = np.diff(np.append(starts, len(tok)))
            least = np.minimum.reduceat(info & 15, starts)
            long = (lengths > PAIR_LIST) | (part[starts] >= 0)
            least[part[starts] >= 0] = 1
            if tied is not None and (tok[0], part[0]) == tied:
                long[0], least[0] = True, 1
            tied = (tok[-1], part[-1]) if long[-1] else None
            if not last and long[-1]:
                least[-1] = 1
            if not last and not long[-1]:  # the last list waits for what follows
                at = starts[-1]
                rest = tuple(x[at:].copy() for x in (tok, part, cls, info))
                starts, lengths, long, least = starts[:-1], lengths[:-1], long[:-1], least[:-1]
            else:
                rest = None
            n = int(lengths.sum())
            kept = long | (lengths > 1)
            out = list(short(cls, info, starts[~long & kept], lengths[~long & kept]))
            live = np.repeat(kept, lengths)
            out.append((cls[:n][live], cls[:n][live], np.repeat(least, lengths)[live]))
            if long.any():
                rows = np.repeat(long, lengths)
                out.append(tie(tok[:n][rows], cls[:n][rows]))
            yield from made(out)

        for batch in batches:
            if not batch.num_rows:
                continue
            own = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if rest is not None:
                own = tuple(np.concatenate(x) for x in zip(rest, own, strict=True))
            yield from handle(*own, last=False)
        if rest is not None:
            own, rest = rest, None
            yield from handle(*own, last=True)

    return run


def _bit(cls: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(cls.astype(np.int64).view(np.uint64)) & _U(bits - 1)).astype(np.int64)


def _member_bits(size: int):
    """(piece, bits) of the classes of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_bit(batch.column(0).to_numpy(), size) for batch in batches if batch.num_rows]
        if not found:
            return
        at = np.unique(np.concatenate(found))
        pieces = at // MEMBER_PIECE
        for piece in np.unique(pieces):
            bits = np.zeros(min(MEMBER_PIECE, size), bool)
            bits[at[pieces == piece] % MEMBER_PIECE] = True
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["piece", "bits"])

    return run


def _or_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own = np.frombuffer(zlib.decompress(blob.as_py()), np.uint8)
            total[piece] = total[piece] | own if piece in total else own
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["piece", "bits"])


def _sets(n: int, members, renamed):
    """(cls, set) of each class that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = members.value, set()
        size = 8 * len(bits)
        for batch in batches:
            clss, blobs, held = [], [], 0
            for _, own in shingle_sets(batch.column(0), n):
                if not len(own):
                    continue
                cls = class_of(own, renamed)
                at = int(_bit(np.array([cls]), size)[0])
                if cls in known or not bits[at >> 3] & 128 >> (at & 7):
                    continue
                known.add(cls)
                clss.append(cls)
                blobs.append(own.tobytes())
                held += len(blobs[-1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(clss, pa.int64()), pa.array(blobs, pa.binary())], names=["cls", "grams"])
                    clss, blobs, held = [], [], 0
            if clss:
                yield pa.RecordBatch.from_arrays([pa.array(clss, pa.int64()), pa.array(blobs, pa.binary())], names=["cls", "grams"])

    return run


def groups_of(sets: list[np.ndarray], num: int, den: int, asked: np.ndarray | None = None, groups: np.ndarray | None = None) -> np.ndarray:
    """For each set the position of the first set of its group of links, by exact intersections.

    ``asked``: only links of these sets are wanted. ``groups``: labels of groups that are known before.
    """
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    root = np.arange(m)
    if groups is not None:
        _, first, label = np.unique(groups, return_index=True, return_inverse=True)
        root = first[label]
    if m < 2:
        return root
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    where = np.repeat(np.arange(m), size)
    shared = times[token] > 1
    token, where = token[shared], where[shared]
    # Shingles that many sets hold are counted by matrix products, the others by their lists.
    heavy = np.flatnonzero(times > max(64, m // 16))
    heavy = heavy[np.argsort(-times[heavy], kind="stable")][: max(1, (32 << 20) // (4 * m))]
    column = np.full(len(times), -1, np.int64)
    column[heavy] = np.arange(len(heavy))
    col = column[token]
    dense = np.zeros((m, len(heavy)), np.float32)
    dense[where[col >= 0], col[col >= 0]] = 1.0
    token, where = token[col < 0], where[col < 0]
    by_set = np.searchsorted(where, np.arange(m + 1))
    order = np.argsort(token, kind="stable")
    lists, sorted_token = where[order], token[order]
    first = np.searchsorted(sorted_token, np.arange(len(times) + 1))
    todo = np.ones(m, bool) if asked is None else asked.copy()
    amount = np.bincount(root, minlength=m)

    def row(i: int) -> np.ndarray:
        own = token[by_set[i] : by_set[i + 1]]
        inter = np.zeros(m, np.int64)
        if len(own):
            a, n = first[own], first[own + 1] - first[own]
            at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            inter = np.bincount(lists[at], minlength=m)
        if len(heavy):
            inter = inter + np.rint(dense @ dense[i]).astype(np.int64)
        return inter

    def merge(i: int) -> np.ndarray:
        inter = row(i)
        linked = np.flatnonzero(den * inter >= num * (size[i] + size - inter))
        joined = np.unique(root[np.append(linked, i)])
        if len(joined) > 1:
            moved = np.isin(root, joined)
            root[moved] = joined[0]
            amount[joined] = 0
            amount[joined[0]] = moved.sum()
        return joined

    if asked is not None:
        # Sets that are not asked have no row, so an asked one needs its own unless all are in its group.
        for i in np.flatnonzero(todo):
            if amount[root[i]] < m:
                merge(i)
        return root
    order = np.argsort(-size, kind="stable")
    while True:
        # Two classes of one group need no row of their own: in the end all without one are in the largest group,
        # and every other pair was met in a row. The largest group may change on the way, so the rest is looked over again.
        largest = int(np.argmax(amount))
        rest = order[todo[order] & (root[order] != largest)]
        if not len(rest):
            break
        for i in rest:
            if root[i] == largest:
                continue
            todo[i] = False
            joined = merge(i)
            if amount[joined[0]] > amount[largest] or largest in joined:
                largest = int(joined[0])
    return root


def _verify(num: int, den: int):
    """Sets sorted by tile (block, x, y) to (block, cls, root), the root being the smallest class of the group found in the tile.

    In tiles with y >= 0 only links of the asked sets are wanted, and ``label`` tells groups known before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close():
            if len(held) > 1:
                own = np.array([h[0] for h in held], np.int64)
                sets = [h[1] for h in held]
                asked, groups = (np.array([h[2] for h in held]), np.array([h[3] for h in held], np.int64)) if key[2] >= 0 else (None, None)
                root = groups_of(sets, num, den, asked, groups)
                least = np.full(len(own), np.iinfo(np.int64).max)
                np.minimum.at(least, root, own)
                linked = least[root] != own
                done.append((np.full(int(linked.sum()), key[0]), own[linked], least[root][linked]))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*done, strict=True)], names=["block", "cls", "root"])
            done.clear()
            return out

        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for b, x, y, c, asked, label, g in zip(*[col.to_pylist() for col in columns[:6]], columns[6], strict=True):
                if (b, x, y) != key:
                    close()
                    key, held = (b, x, y), []
                held.append((c, np.frombuffer(g.as_py(), np.uint64), asked, label))
            if sum(len(d[0]) for d in done) > 50_000:
                yield flush()
        close()
        if done:
            yield flush()

    return run


def _renamed(ids: DataFrame) -> dict[tuple[int, int], int]:
    """New names for all but one of the classes that share their first 64 bits."""
    twice = ids.groupBy("cls").agg(F.min("cls2").alias("first"), F.count("*").alias("k")).where("k > 1")
    found = ids.join(twice, "cls").where("cls2 <> first").select("cls", "cls2").limit(MOST_COLLISIONS + 1).collect()
    if len(found) > MOST_COLLISIONS:
        raise RuntimeError("too many classes share a hash")
    with np.errstate(over="ignore"):
        return {(r.cls, r.cls2): int(mix(mix(np.array([r.cls, r.cls2], np.int64).view(np.uint64)))[[1]].view(np.int64)[0] ^ r.cls) for r in found}


def ngram_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of each row. Links take a Jaccard similarity of at least num / den."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngramjoin")
    ship_package(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    width = sketch_width(texts)
    first = scratch.write(texts.mapInArrow(_classes(words, width), CLASS_SCHEMA), "classes")
    rows = first.where("kind = 0").select("doc_id", "n", "cls", "cls2")
    ids = scratch.write(rows.where("n > 0").groupBy("cls", "cls2").agg(F.min("doc_id").alias("least_id"), F.max("n").alias("n")), "ids")
    renamed = _renamed(ids)
    if renamed:
        # By one shuffle-free lookup; the list is empty on all but the largest inputs.
        names = F.create_map(*[x for (a, b), c in renamed.items() for x in (F.lit(f"{a},{b}"), F.lit(c))])
        name = F.coalesce(F.try_element_at(names, F.concat_ws(",", "cls", "cls2")), F.col("cls"))
        rows, ids = rows.withColumn("cls", name), ids.withColumn("cls", name)
    pieces = first.where("kind = 1").select("piece", "counts").repartition("piece").mapInArrow(_sum_pieces, "piece int, counts binary")
    # At most MOST_SKETCH two-byte counters in all, whatever the input.
    counts = np.zeros(width, np.uint16)
    for r in pieces.toLocalIterator():
        counts[r.piece * SKETCH_PIECE : (r.piece + 1) * SKETCH_PIECE] = np.frombuffer(r.counts, np.uint16)
    sketch = spark.sparkContext.broadcast(counts)

    postings = texts.select("text").mapInArrow(_postings(words, num, den, sketch, renamed), POSTING_SCHEMA)
    found = postings.repartition("tok", "part").sortWithinPartitions("tok", "part", "cls").mapInArrow(_candidates(num, den), CANDIDATE_SCHEMA)
    # Ties have need 0 and pass; a pair passes with as many rows as it needs, and a class with as many shared shingles.
    met = found.groupBy("a", "b").agg(F.count("*").alias("hits"), F.min("need").alias("need")).where("hits >= need")
    met = scratch.write(met, "met")
    live = met.where("a = b").select("a", "hits")
    ties = met.where("need = 0").select("a", "b").join(live.select("a"), "a", "left_semi")
    most = met.where("a <> b").count()
    edges = scratch.write(met.where("need > 0 and a <> b").select("a", "b").unionByName(ties), "edges", most)
    blocks = joined_components(edges, scratch, "blocks")
    members = blocks.join(ids.select(F.col("cls").alias("node"), "n"), "node").join(live.withColumnRenamed("a", "node"), "node", "left")
    members = scratch.write(members.select(F.col("node").alias("cls"), F.col("component").alias("block"), "n", F.coalesce("hits", F.lit(0)).alias("hits")), "members", 2 * most)
    n_members = members.count()

    def shipped_sets(classes: DataFrame, n: int) -> DataFrame:
        """The sets of ``classes`` and of a few others that the filter of hashes lets through."""
        size = min(MOST_BITS, max(MEMBER_PIECE, 1 << (CLASS_BITS * n).bit_length()))
        packed = classes.select("cls").mapInArrow(_member_bits(size), "piece int, bits binary").repartition("piece").mapInArrow(_or_bits, "piece int, bits binary")
        bits = np.zeros(size // 8, np.uint8)
        for r in packed.toLocalIterator():
            bits[r.piece * MEMBER_PIECE // 8 : (r.piece + 1) * MEMBER_PIECE // 8] = np.frombuffer(r.bits, np.uint8)
        return texts.select("text").mapInArrow(_sets(words, spark.sparkContext.broadcast(bits), renamed), "cls long, grams binary").dropDuplicates(["cls"])

    def verified(tiles: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        shipped = tiles.join(sets, "cls").select("block", "x", "y", "cls", "asked", "label", "grams").repartition("block", "x", "y").sortWithinPartitions("block", "x", "y")
        return scratch.write(shipped.mapInArrow(_verify(num, den), "block long, cls long, root long"), name)

    def part(parts: str, seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), "cls"), F.col(parts)).cast("int")

    def pieces_of(k: str, total: str, most_classes: int, most_shingles: int):
        return F.greatest(F.ceil(F.col(k) / most_classes), F.ceil(F.col(total) / most_shingles)).cast("int")

    sizes = members.groupBy("block").agg(F.count("*").alias("k"), F.sum("n").alias("total")).where("k > 1")
    sized = members.join(sizes.select("block", pieces_of("k", "total", TILE_CLASSES, TILE_SHINGLES).alias("parts")), "block")
    # Stored, for leaders, tiles and large blocks all start from here.
    own = scratch.write(sized.withColumn("x", F.when(F.col("parts") > 1, part("parts", 1)).otherwise(F.lit(-1))), "own", n_members)
    leaders = own.where("parts > 1").groupBy("block", "parts", F.pmod(F.xxhash64(F.lit(2), "cls"), F.lit(LEADERS)).alias("salt")).agg(F.max(F.struct("hits", "cls", "x")).alias("l"))
    leaders = leaders.select(F.col("l.cls").alias("cls"), "block", F.col("l.x").alias("home"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("x")).where("x <> home")
    tiles = own.select("cls", "block", "x").unionByName(leaders.select("cls", "block", "x"))
    none = {"y": F.lit(-1), "asked": F.lit(True), "label": F.col("cls")}
    checked = verified(tiles.withColumns(none), shipped_sets(members, n_members), "checked")
    links = checked.select(F.col("cls").alias("a"), F.col("root").alias("b"))
    joined = joined_components(links, scratch, "joined")

    # Classes of large blocks that are not in their block's largest group.
    large = own.where("parts > 1").join(joined.select(F.col("node").alias("cls"), "component"), "cls", "left").select("cls", "block", "n", F.coalesce("component", "cls").alias("label"))
    large = scratch.write(large, "large", n_members)
    groups = large.groupBy("block", "label").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    per = groups.groupBy("block").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("k"), F.sum("total").alias("total"), F.max(F.struct("k", "label", "total")).alias("top_total"))
    per = per.where("top.k < k").select("block", F.col("top.label").alias("top"), "k", "total", (F.col("k") - F.col("top.k")).alias("rest_k"), (F.col("total") - F.col("top_total.total")).alias("rest_total"))
    per = per.select("block", "top", pieces_of("k", "total", REST_CLASSES, REST_SHINGLES).alias("ys"), pieces_of("rest_k", "rest_total", REST_CLASSES, REST_SHINGLES).alias("xs"))
    rest = large.join(per, "block").withColumns({"asked": F.col("label") != F.col("top"), "my_x": part("xs", 3), "my_y": part("ys", 4)})
    rest = scratch.write(rest, "asked", n_members)
    n_rest = rest.count()
    if n_rest:
        asking = rest.where("asked").select("cls", "block", "label", "asked", F.col("my_x").alias("x"), F.explode(F.sequence(F.lit(0), F.col("ys") - 1)).alias("y"))
        others = rest.select("cls", "block", "label", "asked", "my_x", F.col("my_y").alias("y"), F.explode(F.sequence(F.lit(0), F.col("xs") - 1)).alias("x"))
        others = others.where("not (asked and x = my_x)").withColumn("asked", F.lit(False)).select(*asking.columns)
        more = verified(asking.unionByName(others), shipped_sets(rest, n_rest), "rest")
        links = links.unionByName(more.select(F.col("cls").alias("a"), F.col("root").alias("b")))
        # The roots of a tile stand for groups known before.
        links = links.unionByName(large.select(F.col("cls").alias("a"), F.col("label").alias("b")))
        joined = joined_components(links, scratch, "linked")

    scratch.keep("classes", "ids", "joined", "linked")
    label = ids.join(joined.select(F.col("node").alias("cls"), F.col("component").alias("root")), "cls", "left").select("cls", F.coalesce("root", "cls").alias("root"), "least_id")
    least = label.groupBy("root").agg(F.min("least_id").alias("component_id"))
    final = label.join(least, "root").select("cls", "component_id")
    out = rows.join(final, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("cls")).alias("class_id"))
