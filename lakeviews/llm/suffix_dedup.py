"""Removal of repeated byte strings by a distributed merge sort of suffixes that keeps track of common prefixes.

A string of ``WINDOW`` bytes has one anchor: the position in it whose ``GRAM``
bytes have the least hash (the leftmost of equals).  Equal strings have equal
anchors, so only suffixes that start at anchors, about 1 in 180 bytes, need
sorting.  The strings with one anchor begin in a row; they and their bytes are
the anchor's context.

1. Anchors whose gram occurs once are dropped (counts with map-side sums).
   Contexts that are equal as a whole are repeated and one of them stands for all.
2. The other contexts' suffixes are sorted in each task, front-coded (length
   of the prefix shared with the one before, and the rest), exchanged by gram
   and merged by a loser tree.  A player keeps the length of its common prefix
   with the last winner; two players are compared only where these are equal,
   and from there on.
3. The merge's common prefixes give the trees of suffixes that agree for so
   many bytes.  Joining them from the longest prefix down, the smaller into
   the larger, next neighbours by the bytes before the anchor show which
   strings of a context occur in another.
4. A gram with more than ``LARGE`` different contexts isn't brought into one
   task: the strings of its contexts are matched by 128-bit fingerprints, of
   which a task sends each once.

Spans go back to the texts, which are cut and hashed.

Passages of ``PASSAGE`` words or more that another document holds too may be
shorter than ``WINDOW`` bytes.  They are counted, not removed: the same anchors
are taken over words, contexts that two documents hold count as a whole, and
the strings of the others are matched by 64-bit fingerprints (they are counted, not cut).

Defined results: null texts are empty; texts under ``WINDOW`` bytes lose
nothing; repeated rows repeat each other and both lose the repeated bytes; a
text of one repeated byte is repeated in itself; an empty table gives no rows;
other columns are ignored.  For passages, words are compared and not what
separates them, rows of equal id and text are one document, and what a
document repeats only in itself doesn't count.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import save, small_batches, table

WINDOW = 400
GRAM = 64
PASSAGE = 51  # words
WORD_GRAM = 16  # words
LARGE = 2_000
RUN_BYTES = 24 << 20  # of contexts in a sorted run
PART_BYTES = 4 << 20  # of contexts, or of their strings' fingerprints, that one task merges, about
_LOW = np.uint64(0xFFFFFFFF)


def anchors(sums: np.ndarray, offs: np.ndarray, window: int = WINDOW, size: int = GRAM) -> dict[str, np.ndarray]:
    """Of every anchor: row, at (from the text's start), first and last string's start, gram and context fingerprints.

    ``sums`` are prefix sums of bytes, or of words' hashes.
    """
    empty = {k: np.zeros(0, np.int64) for k in ("row", "at", "first", "last", "gram", "context")}
    long_rows = np.flatnonzero(np.diff(offs) >= window)
    if not len(long_rows):
        return empty
    _, down = bw.powers(len(sums))
    n = len(sums) - size
    gram = bw.mixed((sums[size:] - sums[:n]) * down[:n] + np.uint64(size))
    least = (gram & ~_LOW) | np.arange(n, dtype=np.uint64)
    width, have = window - size + 1, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:len(least) - (width - have)], least[width - have:])
    starts = np.concatenate([np.arange(offs[r], offs[r + 1] - window + 1) for r in long_rows])
    row = np.repeat(long_rows, offs[long_rows + 1] - offs[long_rows] - window + 1)
    at = (least[starts] & _LOW).astype(np.int64)
    begin = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    end = np.append(begin[1:], len(starts)) - 1
    row, at, first, last = row[begin], at[begin], starts[begin], starts[end]
    context = bw.span_hash(sums, first, last + window)
    base = offs[row]
    return {"row": row, "at": at - base, "first": first - base, "last": last - base, "gram": gram[at].view(np.int64), "context": context.view(np.int64)}


def _pieces(raw: np.ndarray, offs: np.ndarray):
    """(place in the text, bytes, offsets): chunks of texts, and a long text in pieces that share ``WINDOW`` - 1 bytes.

    A context that a cut divides becomes two, which hold no string in common.
    """
    if len(offs) > 2 or len(raw) <= 2 * bw.CHUNK:
        yield 0, raw, offs
        return
    for at in range(0, len(raw) - WINDOW + 1, bw.CHUNK):
        piece = raw[at:at + bw.CHUNK + WINDOW - 1]
        yield at, piece, np.array([0, len(piece)])


def _anchored(batches):
    for b in batches:
        keys = b.select(["rid", "size"])  # a text isn't copied for each of its anchors
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            for at, piece, ends in _pieces(raw, offs):
                a = anchors(bw.prefix_sums(piece), ends)
                rows = keys.slice(lo, hi - lo).take(pa.array(a["row"]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(a["gram"]), pa.array(a["context"]), *[pa.array((a[k] + at).astype(np.int32)) for k in ("at", "first", "last")]],
                    ["rid", "size", "gram", "context", "at", "first", "last"])


def _word_sums(hashes: np.ndarray) -> np.ndarray:
    up, _ = bw.powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return sums


def _word_pieces(raw: np.ndarray, offs: np.ndarray):
    """(number of the first word, words' prefix sums, rows' first words): as ``_pieces``, a long text in pieces that share ``PASSAGE`` - 1 words."""
    if len(offs) > 2 or len(raw) <= 2 * bw.CHUNK:
        w = bw.words(raw, offs)
        yield 0, _word_sums(w.hash), w.first
        return
    at, number, size = 0, 0, bw.CHUNK
    while True:
        piece = raw[at:at + size]
        w = bw.words(piece, np.array([0, len(piece)]))
        ends = at + size >= len(raw)
        n = len(w.start) - (not ends)  # the last word may go on
        if not ends and n < PASSAGE:
            size *= 2
            continue
        yield number, _word_sums(w.hash[:n]), np.array([0, n])
        if ends:
            return
        step = n - PASSAGE + 1
        at, number, size = at + int(w.start[step]), number + step, bw.CHUNK


def _word_anchored(batches):
    for b in batches:
        keys = b.select(["rid", "size"])
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            for number, sums, firsts in _word_pieces(raw, offs):
                a = anchors(sums, firsts, PASSAGE, WORD_GRAM)
                rows = keys.slice(lo, hi - lo).take(pa.array(a["row"]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(a["gram"]), pa.array(a["context"]), *[pa.array((a[k] + number).astype(np.int32)) for k in ("first", "last")]],
                    ["rid", "size", "gram", "context", "first", "last"])


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    a, b = a[known:n], b[known:n]
    if a == b:
        return n
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(ordered: list[bytes]) -> tuple[list[int], list[bytes]]:
    shared = [0] + [common(x, y) for x, y in zip(ordered, ordered[1:])]
    return shared, [s[k:] for s, k in zip(ordered, shared)]


def _decoded(shared: list[int], rest: list[bytes]):
    last = b""
    for k, r in zip(shared, rest):
        last = last[:k] + r
        yield k, last


def merged(runs: list[tuple[list[int], list[bytes]]]):
    """Yields (common prefix with the one before, string, run, place in its run) of front-coded sorted runs, in order.

    A loser tree: each inner node keeps the player that lost there.  Every
    player's ``known`` is its common prefix with the last winner on its path;
    the greater known wins unseen (it agrees longer with what was least), and
    equal ones are compared from there on.
    """
    cursors = [_decoded(*r) for r in runs]
    size = 1
    while size < len(runs):
        size *= 2
    text: list[bytes | None] = [None] * size
    known, place = [0] * size, [-1] * size

    def advance(r: int) -> None:
        step = next(cursors[r], None) if r < len(cursors) else None
        place[r] += 1
        known[r], text[r] = step if step is not None else (-1, None)

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's known becomes its common prefix with the winner."""
        if text[x] is None or text[y] is None:
            return (y, x) if text[x] is None else (x, y)
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        a, b, k = text[x], text[y], known[x]
        k = common(a, b, k)
        if k == len(a) or (k < len(b) and a[k] < b[k]):
            known[y] = k
            return x, y
        known[x] = k
        return y, x

    for r in range(size):
        advance(r)
    loser = [0] * size
    players = list(range(size))
    node = size
    while len(players) > 1:
        node //= 2
        up = []
        for i in range(0, len(players), 2):
            w, l = play(players[i], players[i + 1])
            loser[node + i // 2] = l
            up.append(w)
        players = up
    best = players[0]
    while text[best] is not None:
        yield known[best], text[best], best, place[best]
        advance(best)
        at = (best + size) // 2
        while at:
            best, loser[at] = play(best, loser[at])
            at //= 2


def repeats(prefixes: list[int], lefts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For suffixes of one gram in order: the (least, most) bytes before the anchor at which a context's strings occur in another.

    prefixes[i] is the common prefix of suffixes i - 1 and i; lefts are the
    bytes before the anchor, backwards.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    group = list(range(len(lefts)))
    members: list[list | None] = [[(x, i)] for i, x in enumerate(lefts)]

    def top(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in sorted(range(1, len(lefts)), key=lambda j: -prefixes[j]):
        k = prefixes[i]
        a, b = top(i - 1), top(i)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large = members[a]
        for x, j in members[b]:
            p = bisect_left(large, (x, j))
            for y, other in large[max(0, p - 1):p + 1]:
                reach = common(x, y)
                if reach >= WINDOW - k:
                    found[j].append((WINDOW - k, reach))
                    found[other].append((WINDOW - k, reach))
            large.insert(p, (x, j))
        group[b], members[b] = a, None
    return found


SENT = pa.schema([("part", pa.int32()), ("shared", pa.list_(pa.int32())), ("rest", pa.list_(pa.binary())), ("left", pa.list_(pa.binary())),
                  ("one", pa.list_(pa.int64())), ("two", pa.list_(pa.int64())), ("rid", pa.list_(pa.int64())), ("size", pa.list_(pa.int64())),
                  ("at", pa.list_(pa.int32())), ("open", pa.list_(pa.bool_())), ("least", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))])


def _sent_row(part: int, **lists) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32())]
    return pa.RecordBatch.from_arrays(columns + [pa.array([lists.get(f.name)], f.type) for f in list(SENT)[1:]], schema=SENT)


def _runs(held: list[tuple]):
    """Front-coded sorted runs of the contexts' suffixes, one for each part."""
    by: dict[int, list] = {}
    for x in held:
        by.setdefault(x[0], []).append(x[1:])
    for part, rows in sorted(by.items()):
        rows.sort()
        shared, rest = front_coded([r[0] for r in rows])
        _, left, rid, n, at, mine = zip(*rows)
        yield _sent_row(part, shared=shared, rest=rest, left=left, rid=rid, size=n, at=at, open=mine)


def _sent(batches, parts: int, word_parts: int):
    """What a task sends of its texts' contexts: sorted runs, fingerprints of the strings of large grams, and those of passages."""
    held, size = [], 0
    for b in batches:
        rids, sizes, zones, passages = (b.column(c).to_pylist() for c in ("rid", "size", "zones", "passages"))
        zones = [z or [] for z in zones]
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            worded = [(i, z) for i in range(hi - lo) for z in passages[lo + i] or []]
            if worded:
                yield from _word_printed(raw, offs, worded, np.array(rids[lo:hi]), np.array(sizes[lo:hi]), word_parts)
            printed = [(i, z) for i in range(hi - lo) for z in zones[lo + i] if z["large"]]
            if printed:
                yield from _printed(raw, offs, printed, np.array(rids[lo:hi]), np.array(sizes[lo:hi]), parts)
            for i in range(hi - lo):
                text = raw[offs[i]:offs[i + 1]].tobytes()
                for z in zones[lo + i]:
                    if not z["large"]:
                        held.append((z["gram"] % parts, text[z["at"]:z["last"] + WINDOW], text[z["first"]:z["at"]][::-1],
                                     rids[lo + i], sizes[lo + i], z["at"], z["open"]))
                        size += z["last"] + WINDOW - z["first"]
            if size > RUN_BYTES:
                yield from _runs(held)
                held, size = [], 0
    yield from _runs(held)


def _merged(batches):
    """Spans (rid, size, start, end) of open contexts' strings that occur in another context."""
    runs, more = [], []
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("shared", "rest", "left", "rid", "size", "at", "open")]
        for shared, rest, *others in zip(*columns):
            runs.append((shared, rest))
            more.append(others)

    def spans(group):
        if len(group) < 2:
            return
        entries = [[column[place] for column in more[run]] for _, _, run, place in group]
        prefixes = [g[0] for g in group]
        rights = [g[1] for g in group]
        for (left, rid, n, at, mine), right, intervals in zip(entries, rights, repeats(prefixes, [e[0] for e in entries])):
            if not mine:
                continue
            for low, high in sorted(intervals):
                # before the anchor no more than the context has, and so after it
                low, high = max(low, WINDOW - len(right)), min(high, len(left))
                if low <= high:
                    yield rid, n, at - high, at - low + WINDOW

    def rows(found):
        rid, n, start, end = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(n, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["rid", "size", "start", "end"])

    out, group = [], []
    for item in merged(runs) if runs else ():
        if group and item[0] < GRAM:
            out += spans(group)
            group = []
            if len(out) > 20_000:
                yield rows(out)
                out = []
        group.append(item)
    out += spans(group)
    if out:
        yield rows(out)


def _joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    begin = np.flatnonzero(new)
    return starts[begin], ends[np.append(begin[1:], len(starts)) - 1]


def _printed(raw: np.ndarray, offs: np.ndarray, zones: list[tuple], rid: np.ndarray, size: np.ndarray, parts: int):
    """Fingerprints of the strings of contexts of large grams: each is sent once, and what is held twice is told at once (part -1)."""
    row = np.concatenate([np.full(z["last"] - z["first"] + 1, i) for i, z in zones])
    mine = np.concatenate([np.full(z["last"] - z["first"] + 1, z["open"]) for _, z in zones])
    start = np.concatenate([np.arange(z["first"], z["last"] + 1) for _, z in zones]) + offs[row]
    one = span_prints(raw, start)
    # a second hash, over the bytes backwards
    two = span_prints(raw[::-1], len(raw) - start - WINDOW)
    order = np.lexsort((two, one))
    one, two, row, mine, start = (x[order] for x in (one, two, row, mine, start))
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(one)))
    alone = np.zeros(len(one), bool)
    alone[begin[times == 1]] = True
    dest = (one[begin] % np.uint64(parts)).astype(np.int32)
    for part, at in [(-1, np.flatnonzero(np.repeat(times > 1, times) & mine))] + [(int(p), begin[dest == p]) for p in np.unique(dest)]:
        if len(at):
            yield _sent_row(part, one=one[at].view(np.int64), two=two[at].view(np.int64), rid=rid[row[at]], size=size[row[at]],
                            at=(start[at] - offs[row[at]]).astype(np.int32), open=(alone & mine)[at])


def _groups(one: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order by fingerprint; of each group of equals: begin in that order, rows, least and greatest document."""
    order = np.argsort(one, kind="stable")
    one = one[order]
    new = np.ones(len(one), bool)
    new[1:] = one[1:] != one[:-1]
    begin = np.flatnonzero(new)
    return order, begin, np.diff(np.append(begin, len(one))), np.minimum.reduceat(least[order], begin), np.maximum.reduceat(most[order], begin)


def _word_printed(raw: np.ndarray, offs: np.ndarray, zones: list[tuple], rid: np.ndarray, size: np.ndarray, parts: int):
    """Fingerprints of the strings of words: what two documents hold here is told at once (part -1) and sent once."""
    w = bw.words(raw, offs)
    times = np.array([z["last"] - z["first"] + 1 for _, z in zones])
    row, mine, least, most = (np.repeat(np.array(x), times) for x in ([i for i, _ in zones], *([z[k] for _, z in zones] for k in ("open", "least", "most"))))
    at = np.concatenate([np.arange(z["first"], z["last"] + 1) for _, z in zones])
    start = at + w.first[row]
    one = bw.span_hash(_word_sums(w.hash), start, start + PASSAGE)
    order, begin, times, low, high = _groups(one, least, most)
    shared = np.repeat(low < high, times)
    told = order[shared & mine[order]]
    once = begin[low < high]
    sent = np.concatenate([order[~shared], order[once]])
    mine[order[once]] = False
    least[order[once]], most[order[once]] = low[low < high], high[low < high]
    dest = (one[sent] % np.uint64(parts)).astype(np.int32)
    for part, x in [(-1, told)] + [(int(p), sent[dest == p]) for p in np.unique(dest)]:
        if len(x):
            yield _sent_row(part, one=one[x].view(np.int64), rid=rid[row[x]], size=size[row[x]], at=at[x].astype(np.int32), open=mine[x], least=least[x], most=most[x])


def span_prints(raw: np.ndarray, start: np.ndarray) -> np.ndarray:
    return bw.span_hash(bw.prefix_sums(raw), start, start + WINDOW)


def _matched(batches):
    """Spans of open strings whose fingerprint was sent by two tasks."""
    held: list[tuple] = [tuple(b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("one", "two", "rid", "size", "at", "open")) for b in batches for i in range(b.num_rows)]
    if held:
        one, two, rid, size, start, mine = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        same = np.zeros(len(one) + 1, bool)
        same[1:-1] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        hit = order[(same[1:] | same[:-1]) & mine[order]]
        yield _span_rows(rid[hit], size[hit], start[hit])


def _word_matched(batches):
    """Spans of open strings of words that two documents hold."""
    names = ("one", "rid", "size", "at", "open", "least", "most")
    held: list[tuple] = [tuple(b.column(c)[i].values.to_numpy(zero_copy_only=False) for c in names) for b in batches for i in range(b.num_rows)]
    if held:
        one, rid, size, start, mine, least, most = (np.concatenate(x) for x in zip(*held))
        order, _, times, low, high = _groups(one, least, most)
        hit = order[np.repeat(low < high, times) & mine[order]]
        yield _span_rows(rid[hit], size[hit], start[hit], PASSAGE)


def _span_rows(rid: np.ndarray, size: np.ndarray, start: np.ndarray, window: int = WINDOW) -> pa.RecordBatch:
    """Spans of strings that start at each ``start``, neighbours joined."""
    order = np.lexsort((start, size, rid))
    rid, size, start = rid[order], size[order], start[order]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (size[1:] != size[:-1]) | (start[1:] > start[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin, len(rid))[1:] - 1
    return pa.RecordBatch.from_arrays([pa.array(rid[begin]), pa.array(size[begin]), pa.array(start[begin].astype(np.int32)), pa.array((start[last] + window).astype(np.int32))],
                                      ["rid", "size", "start", "end"])


def _told(batches, window: int = WINDOW):
    for b in batches:
        for i in range(b.num_rows):
            yield _span_rows(*(b.column(c)[i].values.to_numpy() for c in ("rid", "size", "at")), window)


SPANS = "rid long, size long, start int, end int"


def _passages(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Spans (rid, size, start, end) of words of contexts that two documents hold; the contexts to be matched by their strings, and the number of these."""
    found = rows.filter(F.col("size") >= 2 * PASSAGE - 1).mapInArrow(_word_anchored, "rid long, size long, gram long, context long, first int, last int")
    often = save(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "passage-often")
    held = save(found.join(often, "gram"), "passage-repeated")
    by_context = save(held.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("least"), F.max("rid").alias("most"),
                                                          F.min(F.struct("rid", "size", "first", "last")).alias("z")), "passage-contexts")
    by_gram = (by_context.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("least").alias("low"), F.max("most").alias("high"))
               .filter("kinds > 1 AND low < high").select("gram"))
    mixed = save(by_context.join(by_gram, "gram"), "passage-mixed")
    whole = (held.join(by_context.filter("least < most").select("gram", "context"), ["gram", "context"])
             .select("rid", "size", F.col("first").alias("start"), (F.col("last") + PASSAGE).alias("end")))
    # one context of each kind stands for what two documents hold; a context of one document is open wherever that holds it
    single = mixed.filter("least < most OR n = 1").select("z.*", "least", "most", (F.col("least") == F.col("most")).alias("open"))
    again = (held.join(mixed.filter("least = most AND n > 1").select("gram", "context", "least", "most"), ["gram", "context"])
             .select("rid", "size", "first", "last", "least", "most", F.lit(True).alias("open")))
    times = F.when(F.col("least") < F.col("most"), 1).otherwise(F.col("n"))
    strings = mixed.agg(F.sum(times * (F.col("z.last") - F.col("z.first") + 1))).first()[0] or 0
    return whole, single.unionByName(again), strings


def spans(rows: DataFrame) -> DataFrame:
    """(rid, size, start, end, words): repeated byte spans of (rid, size, text), and (words) spans of words of passages
    that another document holds; they may overlap.
    """
    # anchors are made twice: a table of them would be the largest of all
    found = rows.filter(F.col("size") >= WINDOW).mapInArrow(_anchored, "rid long, size long, gram long, context long, at int, first int, last int")
    often = save(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "suffix-often")
    # only anchors of repeated grams go on
    held = save(found.join(often, "gram"), "suffix-repeated")
    by_context = save(held.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "size", "at", "first", "last")).alias("z")), "suffix-contexts")
    by_gram = by_context.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    whole = (held.join(by_context.filter("n > 1").select("gram", "context"), ["gram", "context"])
             .select("rid", "size", F.col("first").alias("start"), (F.col("last") + WINDOW).alias("end")))
    # one context of each kind stands for all; it is open if it isn't known to be repeated
    open_ = save(by_context.join(by_gram, "gram").select("z.*", "gram", "kinds", (F.col("n") == 1).alias("open")), "suffix-mixed")
    # as many parts as what is sent needs; a gram of at most LARGE contexts is a small piece of one
    strings = F.col("last") - F.col("first") + 1
    total = open_.agg(F.sum(F.when(F.col("kinds") > LARGE, strings * 40).otherwise(strings + WINDOW))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    zone = F.struct("gram", "at", "first", "last", "open", (F.col("kinds") > LARGE).alias("large"))
    known, contexts, total = _passages(rows)
    word_parts = max(1, -(-total * 60 // PART_BYTES))
    # both kinds of contexts meet their texts in one join
    lists = open_.groupBy("rid", "size").agg(F.collect_list(zone).alias("zones")).join(
        contexts.groupBy("rid", "size").agg(F.collect_list(F.struct("first", "last", "open", "least", "most")).alias("passages")), ["rid", "size"], "full")
    sent = rows.join(lists, ["rid", "size"]).select("rid", "size", "text", "zones", "passages").mapInArrow(
        lambda batches: _sent(batches, parts, word_parts), "part int, shared array<int>, rest array<binary>, left array<binary>, one array<long>, two array<long>, "
                                                           "rid array<long>, size array<long>, at array<int>, open array<boolean>, least array<long>, most array<long>")
    sent = save(sent, "suffix-sent")
    runs = sent.filter("shared IS NOT NULL").select("part", "shared", "rest", "left", "rid", "size", "at", "open")
    prints = sent.filter("one IS NOT NULL AND least IS NULL").select("part", "one", "two", "rid", "size", "at", "open")
    passages = sent.filter("least IS NOT NULL").select("part", "one", "rid", "size", "at", "open", "least", "most")
    found = (whole.unionByName(runs.repartitionById(parts, F.col("part")).mapInArrow(_merged, SPANS))
             .unionByName(prints.filter("part < 0").mapInArrow(_told, SPANS))
             .unionByName(prints.filter("part >= 0").repartitionById(parts, F.col("part")).mapInArrow(_matched, SPANS)))
    words = (known.unionByName(passages.filter("part < 0").mapInArrow(lambda batches: _told(batches, PASSAGE), SPANS))
             .unionByName(passages.filter("part >= 0").repartitionById(word_parts, F.col("part")).mapInArrow(_word_matched, SPANS)))
    return found.withColumn("words", F.lit(False)).unionByName(words.withColumn("words", F.lit(True)))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, rid, size): equal rows have one key."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(F.col(doc_id), body).alias("rid"), F.octet_length(body).cast("long").alias("size"))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words), one row per document; ``with_bytes``: and kept, the remaining bytes.

    n_passage_words: words in passages of ``PASSAGE`` words or more that another document holds too, removed or not.
    """
    small_batches(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    found = save(spans(rows.select("rid", "size", "text")), "suffix-spans")
    lists = found.groupBy("rid", "size").agg(*(F.collect_list(F.when(F.col("words") == w, F.col(c))).alias(name) for name, c, w in (
        ("starts", "start", False), ("ends", "end", False), ("word_starts", "start", True), ("word_ends", "end", True))))
    kind = dict(rows.dtypes)["doc_id"]

    def cut(batches):
        for b in batches:
            raw, offs = bw.buffers(b.column("text"))
            starts, ends, word_starts, word_ends = (b.column(c) for c in ("starts", "ends", "word_starts", "word_ends"))
            gone, count, digest, passage, kept = [], [], [], [], []
            for i in range(b.num_rows):
                body = raw[offs[i]:offs[i + 1]]
                if starts[i].is_valid and len(starts[i]):
                    begin, end = _joined(starts[i].values.to_numpy(), ends[i].values.to_numpy())
                    mark = np.zeros(len(body) + 1, np.int8)
                    mark[begin] += 1
                    mark[end] -= 1
                    body = body[np.cumsum(mark[:-1]) == 0]
                    gone.append(int((end - begin).sum()))
                    count.append(len(begin))
                else:
                    gone.append(0)
                    count.append(0)
                if word_starts[i].is_valid and len(word_starts[i]):
                    begin, end = _joined(word_starts[i].values.to_numpy(), word_ends[i].values.to_numpy())
                    passage.append(int((end - begin).sum()))
                else:
                    passage.append(0)
                body = body.tobytes()
                digest.append(hashlib.sha256(body).hexdigest())
                if with_bytes:
                    kept.append(body)
            columns = [b.column("doc_id"), b.column("size"), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(passage, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_bytes,
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words"] + ["kept"] * with_bytes)

    return rows.join(lists, ["rid", "size"], "left").select("doc_id", "size", "text", "starts", "ends", "word_starts", "word_ends").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long" + ", kept binary" * with_bytes)


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"), with_bytes=False)
