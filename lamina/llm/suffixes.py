"""Repeated byte strings, found exactly by suffix arrays of shards.

Each byte that a string of ``size`` bytes covers is removed if that string starts earlier too. Sorting every suffix of the
corpus against every other would ship ``size`` times the input, so texts are dealt to shards by content first:

1. Each window of ``size`` bytes has an anchor, the place in it with the least hash of the next ``size - 63`` bytes. Equal
   windows have equal anchors, and neighbours mostly share theirs, so there are about 3 anchors per 100 bytes.
   Anchors whose hash occurs once in the corpus (windows.repeats counts them) cannot belong to a repeated window.
2. The others send their context, the bytes of all windows they anchor, to the shard of their hash. Equal contexts of
   a chunk of texts are sent once, so a passage that a third of all documents share costs a shard one context per chunk.
3. A shard builds the suffix array of its contexts by Larsson-Sadakane refinement (sort by seven bytes, then double the
   depth and sort only groups that are still tied), common prefixes by Kasai's rule (one comparison per run of places whose
   predecessors follow each other), and so groups equal windows. All but the earliest place of a group are removed.
4. A bucket with too many contexts is dealt to several shards. They then pass on their distinct windows with the
   earliest place of each, by hash; a merge finds each shard's windows in the others by binary search.

Windows are compared byte by byte within shards; hashes only decide what may be equal, and in 4 what is.
Null, empty and short texts lose nothing. Rows without an id come after all others. Rows that share an id count as one
document: of equal places neither removes the other. Texts of any length are read in overlapping pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import MB, _BYTE, chunks, id_back, mixed, packed, powers, stored, table
from lamina.llm.windows import bucket_bits, repeats

CHUNK, PIECE, SPREAD, MERGES = 2 * MB, MB, 64, 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(2**24 - 1)


# ---------------------------------------------------------------- anchors

def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` bytes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    n = len(data) - size + 1
    return mixed((total[size:] - total[:n]) * down[:n])


def runs(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: the text, the first and last window in it, and the hash of the anchor."""
    width = size - SPREAD + 1
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    out = [[np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]]
    for at in range(0, len(data) - size + 1, PIECE):
        part = data[at : at + PIECE + size - 1]
        h = _hashes(part, width)
        least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while step < SPREAD:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        anchor = (least & _LOW).astype(np.int64)
        place = at + np.arange(len(anchor))
        row = np.searchsorted(ends, place, "right")
        inside = place + size <= ends[np.minimum(row, len(ends) - 1)]
        place, anchor, row = place[inside], anchor[inside], row[inside]
        if len(place) == 0:
            continue
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
        first, last = np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:] - 1, len(new) - 1]
        begin = np.r_[0, ends[:-1]][row[first]]
        out.append([row[first], place[first] - begin, place[last] - begin, mixed(h[anchor[first]] * _ODD)])  # the least of 64 hashes is small: mix again for even buckets
    return tuple(map(np.concatenate, zip(*out, strict=True)))


# ---------------------------------------------------------------- suffix arrays

def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their next ``depth`` codes (at least), and the first seven codes of each as one number.

    Codes are below 512 and 0 ends a text. Larsson-Sadakane: the rank of a place is the start of its group; each round
    sorts the members of groups of several by the rank of the place ``h`` further on, and doubles ``h``.
    """
    n = len(codes)
    padded = np.concatenate([codes.astype(np.uint64), np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = key << np.uint64(9) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    rank = np.zeros(n + 1, np.int64)
    new = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.empty(0, bool)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1 if n else 0
    tied = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else np.empty(0, np.int64)
    h = 7
    while h < depth and len(tied):
        place = order[tied]
        both = rank[place] * (n + 2) + rank[np.minimum(place + h, n)]
        by = np.argsort(both, kind="stable")
        place, both = place[by], both[by]
        order[tied] = place
        new = np.r_[True, both[1:] != both[:-1]]
        rank[place] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1
        tied = tied[~(new & np.r_[new[1:], True])]
        h *= 2
    return order, key


def common_prefixes(codes: np.ndarray, order: np.ndarray, key: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each place with its predecessor in ``order``, within ``rest`` codes.

    Kasai's rule in the order of places: where place and predecessor both follow those of the place before, the prefix
    is one shorter than there. Only the others are compared, seven codes at a time.
    """
    n = len(codes)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    start = np.ones(n, bool)
    start[1:] = (before[1:] != before[:-1] + 1) | (before[1:] <= 0) | (codes[:-1] == 0) | (codes[np.maximum(before[1:] - 1, 0)] == 0)
    out = np.zeros(n, np.int64)
    place = np.flatnonzero(start & (before >= 0))
    most = np.minimum(rest[place], rest[before[place]])
    length, active = np.zeros(len(place), np.int64), np.arange(len(place))
    padded = np.concatenate([key, np.zeros(1, np.uint64)])
    while len(active):
        a, b = place[active] + length[active], before[place[active]] + length[active]
        differ = padded[np.minimum(a, n)] ^ padded[np.minimum(b, n)]
        same = differ == 0
        bits = np.where(same, 0, 63 - np.floor(np.log2(np.maximum(differ, 1).astype(np.float64))).astype(np.int64))
        # the highest differing bit of 63 tells how many of the seven codes agree; rounding up to 2**k is corrected
        exact = np.where(same, 7, np.minimum((bits - 1) // 9, 6))
        wrong = ~same & (differ >> (np.uint64(63) - np.uint64(9) * exact.astype(np.uint64)) != 0)
        exact = exact - wrong
        length[active] += exact
        active = active[same & (length[active] < most[active])]
    out[place] = np.minimum(length, most)
    last = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    out = np.where(start, out, np.maximum(out[last] - (np.arange(n) - last), 0))
    return out


def equal_windows(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of the texts: the text, the place in it, and a number that equal windows share."""
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    ends = np.cumsum(lengths + 1) - 1
    codes[ends] = 0
    row = np.repeat(np.arange(len(texts)), lengths + 1)
    rest = ends[row] - np.arange(len(codes))
    order, key = suffix_array(codes, size)
    prefix = common_prefixes(codes, order, key, rest)
    group = np.cumsum(prefix[order] < size)
    whole = rest[order] >= size
    place = order[whole]
    return row[place], place - (ends[row[place]] - lengths[row[place]]), group[whole]


# ---------------------------------------------------------------- shards

def _spans(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
    """A row for each document, with the first and last place of its removed windows."""
    by = np.argsort(doc, kind="stable")
    pairs, doc = np.c_[first, last][by].astype("<i8"), doc[by]
    cuts = np.r_[0, np.flatnonzero(np.diff(doc)) + 1, len(doc)] if len(doc) else np.zeros(1, int)
    return pd.DataFrame({"doc_id": doc[cuts[:-1]], "spans": [pairs[x:y].tobytes() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]})


def _of_one_shard(contexts: list[bytes], doc: np.ndarray, start: np.ndarray, size: int) -> tuple[tuple, tuple]:
    """Removed (doc, first, last) windows among contexts at (doc, start), and the (hash, doc, place) of each distinct window."""
    by = np.lexsort((start, doc))
    kept: dict[bytes, int] = {}
    own, gone = [], []
    for i in by.tolist():
        k = kept.setdefault(contexts[i], len(own))
        if k == len(own):
            own.append(i)
        elif (doc[i], start[i]) != (doc[own[k]], start[own[k]]):
            gone.append(i)
    own, gone = np.array(own, np.int64), np.array(gone, np.int64)
    longs = np.array([len(c) for c in contexts], np.int64)
    texts = [contexts[i] for i in own.tolist()]
    row, place, group = equal_windows(texts, size)
    d, p = doc[own][row], start[own][row] + place
    order = np.lexsort((p, d, group))
    row, place, group, d, p = row[order], place[order], group[order], d[order], p[order]
    new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, bool)
    least = np.cumsum(new) - 1
    later = (d > d[new][least]) | (p > p[new][least]) if len(group) else new
    removed = (np.r_[doc[gone], d[later]], np.r_[start[gone], p[later]], np.r_[start[gone] + longs[gone] - size, p[later]])
    joined = np.frombuffer(b"".join(texts), np.uint8)
    offset = np.cumsum([0, *map(len, texts)])[:-1]
    hashes = _hashes(joined, size)[offset[row[new]] + place[new]] if len(group) else np.empty(0, np.uint64)
    return removed, (hashes, d[new], p[new])


def _merge_neighbours(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by = np.lexsort((first, doc))
    doc, first, last = doc[by], first[by], last[by]
    if len(doc) == 0:
        return doc, first, last
    apart = np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) << 40  # so that no running maximum reaches into the next document
    new = np.r_[True, (first + apart)[1:] > np.maximum.accumulate(last + apart)[:-1] + 1]
    at = np.flatnonzero(new)
    return doc[at], first[at], np.maximum.reduceat(last, at)


def _small_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for a, b in chunks([3 * len(t) for t in rows["text"]], 4 * CHUNK):
            yield rows.iloc[a:b]


def removed_windows(docs: DataFrame, size: int = 100, shard_contexts: int = 30_000) -> DataFrame:
    """doc_id and spans: first and last place (pairs of 64-bit numbers) of windows that start earlier too."""
    if size <= SPREAD:
        raise ValueError(f"size must be above {SPREAD}")
    bits = bucket_bits(docs, MB)

    def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        row, _, _, h = runs(texts, size)
        return h, row

    found = stored(repeats(docs, anchors, bits, everyone=True), "anchors")
    large = found.groupBy("bucket").agg(F.sum(F.length("hashes") / 8).alias("n")).where(F.col("n") > shard_contexts)
    shards = {r["bucket"]: int(np.ceil(r["n"] / shard_contexts)) for r in large.collect()}  # as many as buckets at most

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain, small = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        for rows in batches:
            for a, b in chunks([3 * len(t) for t in rows["text"]], CHUNK):  # packed to about a third
                ids = rows["doc_id"].to_numpy(np.int64)[a:b]
                texts = [plain.decompress(t) for t in rows["text"].iloc[a:b]]
                order = np.argsort(ids, kind="stable")
                ids, texts = ids[order], [texts[i] for i in order]
                wanted = [b"".join(rows["found"].iloc[a + i]) for i in order]
                row, first, last, h = runs(texts, size)
                pairs = np.frombuffer(b"".join(wanted), np.uint64)
                owner = np.repeat(np.arange(len(texts)), [len(w) // 8 for w in wanted])
                ok = np.isin(mixed(h + row.astype(np.uint64) * _ODD), mixed(pairs + owner.astype(np.uint64) * _ODD))
                row, first, last, h = row[ok], first[ok], last[ok], h[ok]
                seen: dict[tuple, int] = {}
                send, gone = [], []
                for i, (r, x, y, k) in enumerate(zip(row.tolist(), first.tolist(), last.tolist(), h.tolist(), strict=True)):
                    context = texts[r][x : y + size]
                    j = seen.setdefault((k, context), i)
                    if j == i:
                        send.append((i, context))
                    elif (ids[r], x) != (ids[row[j]], first[j]):
                        gone.append(i)
                salt = int(ids[0]) if len(ids) else 0
                for kind, places in ((0, np.array([i for i, _ in send], np.int64)), (1, np.array(gone, np.int64))):
                    bucket = (h[places] >> np.uint64(64 - bits)).astype(np.int64)
                    by = np.argsort(bucket, kind="stable")
                    cuts = np.r_[0, np.flatnonzero(np.diff(bucket[by])) + 1, len(by)] if len(by) else np.zeros(1, int)
                    out = []
                    for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        at = places[by[x:y]]
                        k = int(bucket[by[x]])
                        out.append({
                            "bucket": k, "salt": (salt * 2654435761 >> 7) % shards.get(k, 1), "kind": kind, "ids": ids[row[at]].astype("<i8").tobytes(),
                            "first": first[at].astype("<i8").tobytes(), "last": last[at].astype("<i8").tobytes(),
                            "data": small.compress(b"".join(send[i][1] for i in by[x:y].tolist())) if kind == 0 else b"",
                        })
                    if out:
                        yield pd.DataFrame(out)

    def sharded(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        done = [[np.empty(0, np.int64)] * 3]
        texts, doc, start = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for r in rows.itertuples():
            ids, first, last = (np.frombuffer(x, "<i8") for x in (r.ids, r.first, r.last))
            if r.kind:
                done.append([ids, first, last])
                continue
            at, data = 0, zstandard.ZstdDecompressor().decompress(r.data)
            for n in (last - first + size).tolist():
                texts.append(data[at : at + n])
                at += n
            doc.append(ids)
            start.append(first)
        windows = None
        if texts:
            removed, windows = _of_one_shard(texts, np.concatenate(doc), np.concatenate(start), size)
            done.append(removed)
        out = _spans(*_merge_neighbours(*map(np.concatenate, zip(*done, strict=True)))).assign(merge=-1, windows=None)
        if windows and shards.get(key[0], 1) > 1:
            part = (windows[0] & np.uint64(MERGES - 1)).astype(np.int64)
            by = np.lexsort((windows[0], part))
            cuts = np.searchsorted(part[by], np.arange(MERGES + 1)).tolist()
            h, d, p = (x[by].view(np.uint64) for x in windows)
            more = [{"doc_id": 0, "spans": None, "merge": int(key[0]) * MERGES + k, "windows": np.stack([h[x:y], d[x:y], p[x:y]]).tobytes()} for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
            out = pd.concat([out, pd.DataFrame(more)], ignore_index=True)
        return out[["doc_id", "spans", "merge", "windows"]]

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Each shard's windows are looked up among all, which are sorted by hash and then by place."""
        parts = [np.frombuffer(w, np.uint64).reshape(3, -1) for w in rows["windows"]]
        h, d, p = np.concatenate(parts, axis=1)
        d, p = d.view(np.int64), p.view(np.int64)
        by = np.lexsort((p, d, h))
        h, d, p = h[by], d[by], p[by]
        done = [[np.empty(0, np.int64)] * 3]
        for part in parts:
            at = np.searchsorted(h, part[0])
            own_d, own_p = part[1].view(np.int64), part[2].view(np.int64)
            later = (d[at] != own_d) | (p[at] != own_p)
            done.append([own_d[later], own_p[later], own_p[later]])
        return _spans(*map(np.concatenate, zip(*done, strict=True)))

    wanted = found.groupBy("doc_id").agg(F.collect_list("hashes").alias("found"))
    sent = packed(docs).join(wanted, "doc_id").mapInPandas(contexts, "bucket long, salt long, kind int, ids binary, first binary, last binary, data binary")
    judged = stored(sent.groupBy("bucket", "salt").applyInPandas(sharded, "doc_id long, spans binary, merge long, windows binary"), "shards")
    across = judged.where("merge >= 0").groupBy("merge").applyInPandas(merged, "doc_id long, spans binary")
    return judged.where("merge < 0").select("doc_id", "spans").union(across)


def remove_repeats(docs: DataFrame, size: int = 100) -> DataFrame:
    """doc_id (null: the last key), n_bytes, n_removed, the removed ``spans`` (bytes, end exclusive) and the ``kept`` bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = zstandard.ZstdDecompressor()
        for rows in _small_batches(batches):
            out = []
            for text, found in zip(map(plain.decompress, rows["text"]), rows["found"], strict=True):
                spans, kept = [], text
                if found is not None and len(found):
                    pairs = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                    end = np.maximum.accumulate(pairs[:, 1] + size)
                    new = np.r_[True, pairs[1:, 0] > end[:-1]]
                    at = np.flatnonzero(new)
                    spans = list(zip(pairs[at, 0].tolist(), end[np.r_[at[1:] - 1, len(end) - 1]].tolist(), strict=True))
                    # rows that share an id may be shorter than the one a span was found in
                    spans = [(x, min(y, len(text))) for x, y in spans if x < len(text)]
                    kept = b"".join(text[x:y] for x, y in zip([0, *(y for _, y in spans)], [*(x for x, _ in spans), len(text)], strict=True))
                out.append((len(text), len(text) - len(kept), [{"start": x, "end": y} for x, y in spans], kept))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "spans", "kept"]).assign(doc_id=rows["doc_id"].to_numpy())

    found = removed_windows(docs, size).groupBy("doc_id").agg(F.collect_list("spans").alias("found"))
    return packed(docs).join(found, "doc_id", "left").mapInPandas(cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


def op7_suffixes(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(id_back(), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
