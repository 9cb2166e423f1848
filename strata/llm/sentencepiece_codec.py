"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are joined into one text, whose suffixes are
sorted as far as the longest piece reaches.  A binary search of every piece in
that order gives all its occurrences, which are the edges of a graph over text
positions.  The edges are sorted by position and relaxed: an edge is kept if
its piece and the piece before it are what byte-pair merging would leave side
by side, which holds for exactly one edge per position, so following the kept
edges back from a word's end gives the pieces of the library's own encoding.

Whether two pieces stand side by side is decided by undoing their merges from
the last one on, and looking for a pair across the border that would have
merged first.  Characters without a piece become byte pieces.

Null texts have null ids and decode to null; the empty text has no ids; long
texts are encoded whole; repeated rows encode alike; an empty table gives an
empty table.  U+2581 stands for a space in the model, so a text that holds it
decodes with spaces instead.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.words import EXACT_BYTES, bounded_batches, byte_class, mix, parts, release, words_of

SPACE = "▁"
#: Characters of distinct words that are indexed at once.
INDEX_CHARS = 150_000
#: Bytes of text whose words are looked up at once.
PART_BYTES = 500_000
#: Megabytes of an Arrow batch at most.
ARROW_MB = 2
_GAP = byte_class(" \n")
_NEVER = np.iinfo(np.int32).max
_CACHE_BITS = 19


@dataclass
class Model:
    """Pieces as arrays; what merging needs to know about each."""

    name: str
    pieces: list[str]
    #: Output bytes of each id.
    output: list[bytes]
    byte_ids: np.ndarray
    #: Ids of the longest run of spaces, its length, and ids of each shorter run.
    space: int
    run: int
    run_length: int
    short_runs: list[np.ndarray]
    #: Merge rank of a piece (-1: a single character) and the two pieces it is merged from.
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    #: Pairs that merge, as left * size + right, sorted, and the rank of the result.
    pair: np.ndarray
    pair_rank: np.ndarray
    #: Pieces that occur in words, as rows of character codes padded with -1.
    code_of: dict[str, int]
    searched: np.ndarray
    spelled: np.ndarray
    length: np.ndarray
    cache: tuple = field(default=None, repr=False)

    @property
    def size(self) -> int:
        return len(self.pieces)


def load(path: str) -> Model:
    """Read a byte-pair model with byte fallback, and derive its merge tables."""
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    pieces = [p.id_to_piece(i) for i in range(n)]
    score = [p.get_score(i) for i in range(n)]
    normal = [i for i in range(n) if not (p.is_unknown(i) or p.is_control(i) or p.is_byte(i) or p.is_unused(i))]
    ids = {pieces[i]: i for i in normal}
    if p.encode(" a\n b") != p.encode(" a\n b".replace(" ", SPACE)) or any(
        re.search(f".{SPACE}", pieces[i]) and set(pieces[i]) != {SPACE} for i in normal
    ):
        raise ValueError("only models that mark spaces before words, without normalisation, are supported")
    run_length = max(len(pieces[i]) for i in normal if set(pieces[i]) == {SPACE})
    short_runs = [np.array(p.encode(" " * (r - 1)) if r > 1 else [ids[SPACE]] * r, np.int32) for r in range(run_length)]
    for r in range(run_length, 3 * run_length):  # runs of spaces are filled from the left
        whole, rest = divmod(r, run_length)
        if p.encode(" " * (r - 1)) != [ids[SPACE * run_length]] * whole + short_runs[rest].tolist():
            raise ValueError("runs of spaces are merged in an order that is not supported")
    words = [i for i in normal if len(pieces[i]) == 1 or set(pieces[i]) != {SPACE}]
    order = sorted((i for i in words if len(pieces[i]) > 1), key=lambda i: -score[i])
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.arange(len(order))
    left, right = np.full(n + 1, -1, np.int32), np.full(n + 1, -1, np.int32)
    mergeable = {pieces[i]: i for i in words}
    dead = set()
    for i in order:
        split = _last_merge(pieces[i], mergeable, rank)
        if split is None:
            dead.add(i)
        else:
            left[i], right[i] = split
            if max(rank[split[0]], rank[split[1]]) > rank[i]:
                raise ValueError("a piece ranks before the pieces it is merged from")
    pair, pair_rank = [], []
    for i in order:
        word = pieces[i]
        for k in range(1, len(word)):
            if word[:k] in mergeable and word[k:] in mergeable:
                pair.append(mergeable[word[:k]] * (n + 1) + mergeable[word[k:]])
                pair_rank.append(rank[i])
    by = np.argsort(pair)
    searched = np.array([i for i in words if i not in dead], np.int32)
    code_of = {c: k + 2 for k, c in enumerate(sorted({c for i in searched for c in pieces[i]}))}
    longest = max(len(pieces[i]) for i in searched)
    spelled = np.full((len(searched), longest), -1, np.int32)
    for row, i in enumerate(searched):
        spelled[row, : len(pieces[i])] = [code_of[c] for c in pieces[i]]
    name = hashlib.sha256(p.serialized_model_proto()).hexdigest()
    return Model(
        name,
        pieces,
        [bytes([int(x[3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(pieces)],
        np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32),
        ids[SPACE], ids[SPACE * run_length], run_length, short_runs, rank, left, right,
        np.array(pair, np.int64)[by], np.array(pair_rank, np.int32)[by],
        code_of, searched, spelled, np.array([len(x) for x in pieces] + [1], np.int32),
    )


def _last_merge(word: str, ids: dict[str, int], rank: np.ndarray) -> tuple[int, int] | None:
    """The two pieces whose merge completes ``word``; none if merging never completes it."""
    symbols = list(word)
    while len(symbols) > 1:
        best = min(
            ((rank[ids[a + b]], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in ids),
            default=None,
        )
        if best is None:
            return None
        k = best[1]
        if len(symbols) == 2:
            return (ids[symbols[0]], ids[symbols[1]]) if symbols[0] in ids and symbols[1] in ids else None
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
    return None


def side_by_side(model: Model, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging leaves piece ``a`` before piece ``b`` (``size``: no piece)."""
    if model.cache is None:
        model.cache = (np.full(1 << _CACHE_BITS, -1, np.int64), np.zeros(1 << _CACHE_BITS, bool))
    keys, values = model.cache
    key = a.astype(np.int64) * (model.size + 1) + b
    slot = (mix(key.view(np.uint64)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
    unknown = np.flatnonzero(keys[slot] != key)
    out = values[slot]
    if len(unknown):
        fresh, where = np.unique(key[unknown], return_inverse=True)
        found = _undo(model, *np.divmod(fresh, model.size + 1))
        out[unknown] = found[where]
        place = (mix(fresh.view(np.uint64)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        keys[place], values[place] = fresh, found
    return out


def _undo(model: Model, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Undo the merges of both sides, latest first, until a pair across merges or both are characters."""
    apart = np.ones(len(x), bool)
    live = np.arange(len(x))
    above_x = np.full(len(x), _NEVER, np.int32)
    above_y = np.full(len(x), _NEVER, np.int32)
    while len(live):
        key = x * (model.size + 1) + y
        at = np.minimum(np.searchsorted(model.pair, key), len(model.pair) - 1)
        r = np.where(model.pair[at] == key, model.pair_rank[at], _NEVER)
        # on equal ranks the left of two merges is done first
        across = (r < above_x) & (r <= above_y) & (r < _NEVER)
        apart[live[across]] = False
        rx, ry = model.rank[x], model.rank[y]
        go = ~across & ((rx >= 0) | (ry >= 0))
        undo_x = rx > ry
        x, y, above_x, above_y = (
            np.where(undo_x, model.right[x], x)[go],
            np.where(undo_x, y, model.left[y])[go],
            np.where(undo_x, rx, above_x)[go],
            np.where(undo_x, above_y, ry)[go],
        )
        live = live[go]
    return apart


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes, as far as ``depth`` characters.

    Doubling: ranks by the first 4 characters, then by pairs of ranks.
    """
    bits = int(text.max(initial=1)).bit_length()
    key, reach = text.astype(np.int64), 1
    for step in (1, 2):
        if bits * 2 * step <= 62:
            later = np.zeros_like(key)
            later[:-reach] = key[reach:]
            key = (key << bits * step) | later
            reach *= 2
    while True:
        order = np.argsort(key)
        if reach >= depth:
            return order
        new = np.zeros(len(key), np.int64)
        new[1:] = np.diff(key[order]) != 0
        rank = np.empty_like(key)
        rank[order] = np.cumsum(new) + 1
        later = np.zeros_like(key)
        later[:-reach] = rank[reach:]
        key = rank * (int(rank.max()) + 1) + later
        reach *= 2


def _packed(codes: np.ndarray, per: int, bits: int) -> np.ndarray:
    """Each position's next ``per`` characters in one number."""
    key = np.zeros(len(codes) - per + 1, np.int64)
    for i in range(per):
        key = (key << bits) | codes[i : len(codes) - per + 1 + i]
    return key


def _wanted_keys(spelled: np.ndarray, per: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed characters of the pieces, group by group; behind a piece's end the lowest and the highest."""
    n, longest = spelled.shape
    groups = -(-longest // per)
    padded = np.full((n, groups * per), -1, np.int64)
    padded[:, :longest] = spelled
    low, high = np.zeros((groups, n), np.int64), np.zeros((groups, n), np.int64)
    for g in range(groups):
        for i in range(per):
            column = padded[:, g * per + i]
            low[g] = (low[g] << bits) | np.maximum(column, 0)
            high[g] = (high[g] << bits) | np.where(column < 0, (1 << bits) - 1, column)
    return low, high


#: Packed pieces by model, characters in a number, and bits of a character.
_keys: dict[tuple[str, int, int], tuple[np.ndarray, np.ndarray]] = {}


def _search(key: np.ndarray, order: np.ndarray, shift: int, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray,
            upper: bool) -> np.ndarray:
    """Binary search of each wanted key in its own range of suffixes, by the characters ``shift`` behind."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        middle = (lo[live] + hi[live]) // 2
        seen = key[order[middle] + shift]
        right = seen <= wanted[live] if upper else seen < wanted[live]
        lo[live[right]] = middle[right] + 1
        hi[live[~right]] = middle[~right]
        live = live[lo[live] < hi[live]]
    return lo


def occurrences(model: Model, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece occurs: starts and piece ids of all edges.

    All pieces are searched by their first characters; those that go on are
    searched on by the next ones, within what is left of their ranges.
    """
    longest = model.spelled.shape[1]
    order = suffix_order(text, longest)
    bits = int(max(text.max(initial=1), model.spelled.max(initial=1))).bit_length()
    per = max(1, min(4, 62 // bits))
    key = _packed(np.concatenate([text, np.zeros(longest + per, text.dtype)]).astype(np.int64), per, bits)
    low, high = _keys.get((model.name, per, bits)) or _keys.setdefault(
        (model.name, per, bits), _wanted_keys(model.spelled, per, bits)
    )
    sorted_keys = key[order]
    first = np.searchsorted(sorted_keys, low[0], "left")
    last = np.searchsorted(sorted_keys, high[0], "right")
    length = (model.spelled >= 0).sum(1)
    for group in range(1, len(low)):
        on = np.flatnonzero((length > group * per) & (first < last))
        if not len(on):
            break
        begin, end = first[on], last[on]
        first[on] = _search(key, order, group * per, begin, end, low[group][on], False)
        last[on] = _search(key, order, group * per, begin, end, high[group][on], True)
    count = np.maximum(last - first, 0)
    piece = np.repeat(model.searched, count)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return order[place], piece


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of each word, all in one array, and where each word's begin."""
    size = np.array([len(w) for w in words], np.int64)
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    u, number = np.unique(chars, return_inverse=True)
    code = np.array([model.code_of.get(chr(c), 1) for c in u], np.int32)[number]
    # a 0 after every word keeps pieces from reaching into the next
    word = np.repeat(np.arange(len(words)), size)
    text = np.zeros(len(chars) + len(words), np.int32)
    at = np.arange(len(chars)) + word
    text[at] = code
    begin = np.cumsum(size + 1) - size - 1
    start, piece = occurrences(model, text)
    # characters without a piece of their own are edges too
    uncovered = text > 0
    uncovered[start[model.length[piece] == 1]] = False
    alone = np.flatnonzero(uncovered)
    start = np.concatenate([start, alone])
    piece = np.concatenate([piece, np.full(len(alone), model.size, np.int32)])
    end = start + model.length[piece]
    owner = np.zeros(len(text) + 1, np.int64)
    owner[at] = word
    offset = end - begin[owner[start]]
    order = np.argsort(offset, kind="stable")
    start, end, piece, offset = start[order], end[order], piece[order], offset[order]
    last = np.full(len(text) + 1, -1, np.int32)
    fresh = np.zeros(len(text) + 1, bool)
    fresh[begin] = True
    cuts = np.flatnonzero(np.append(True, np.diff(offset) != 0)) if len(offset) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(offset)), strict=True) if len(offset) else ():
        s, t = start[a:b], piece[a:b]
        before = last[s]
        good = fresh[s].copy()
        ask = np.flatnonzero(~good & (before >= 0))
        good[ask] = side_by_side(model, before[ask], t[ask])
        last[end[a:b][good]] = t[good]
    # follow the kept edges back from the ends
    here, who = begin + size, np.arange(len(words))
    found, owners, steps, step = [], [], [], 0
    live = here > begin
    here, who = here[live], who[live]
    while len(here):
        t = last[here]
        found.append(t)
        owners.append(who)
        steps.append(np.full(len(t), step))
        step += 1
        here = here - model.length[t]
        more = here > begin[who]
        here, who = here[more], who[more]
    if not found:
        return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
    found, owners, steps = (np.concatenate(x) for x in (found, owners, steps))
    order = np.lexsort((-steps, owners))
    ids, owners = found[order], owners[order]
    unknown = np.flatnonzero(ids == model.size)
    if len(unknown):
        ids, owners = _with_bytes(model, words, ids, owners)
    return ids, np.searchsorted(owners, np.arange(len(words) + 1))


def _with_bytes(model: Model, words: list[str], ids: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by the pieces of their bytes."""
    lengths = model.length[ids]
    place = np.cumsum(lengths) - lengths
    new = np.ones(len(ids), bool)
    new[1:] = owners[1:] != owners[:-1]
    origin = np.maximum.accumulate(np.where(new, place, 0))
    out, who = [], []
    limits = np.flatnonzero(ids == model.size)
    previous = 0
    for i in limits:
        out.append(ids[previous:i])
        who.append(owners[previous:i])
        spelled = words[owners[i]][place[i] - origin[i]].encode("utf-8")
        out.append(model.byte_ids[np.frombuffer(spelled, np.uint8)])
        who.append(np.full(len(spelled), owners[i]))
        previous = i + 1
    out.append(ids[previous:])
    who.append(owners[previous:])
    return np.concatenate(out), np.concatenate(who)


def _encode_distinct(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``encode_words`` in blocks of bounded size."""
    ids, starts, total, at = [], [np.zeros(1, np.int64)], 0, 0
    sizes = np.cumsum([len(w) for w in words])
    while at < len(words):
        done = sizes[at - 1] if at else 0
        to = max(int(np.searchsorted(sizes, done + INDEX_CHARS, "right")), at + 1)
        some, first = encode_words(model, words[at:to])
        ids.append(some)
        starts.append(first[1:] + total)
        total += len(some)
        at = to
    return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.concatenate(starts)


def _stops(texts) -> tuple[np.ndarray, ...]:
    """Words and line feeds in order: row, begin, end, word hash (0: none), spaces before.

    Every text ends with a stop of no length.
    """
    words = words_of(texts, _GAP, EXACT_BYTES)
    line = np.flatnonzero(texts.data == 10)
    line_row = np.searchsorted(texts.start, line, "right") - 1
    rows = np.arange(texts.rows)
    row = np.concatenate([words.row, line_row, rows])
    begin = np.concatenate([words.begin, line, texts.start[1:]])
    end = np.concatenate([words.end, line + 1, texts.start[1:]])
    kind = np.concatenate([np.zeros(len(words.row), int), np.ones(len(line), int), np.full(len(rows), 2)])
    hashed = np.concatenate([words.hash, np.zeros(len(line) + len(rows), np.uint64)])
    order = np.lexsort((kind == 2, begin, row))
    row, begin, end, kind, hashed = (x[order] for x in (row, begin, end, kind, hashed))
    before = np.empty_like(begin)
    before[1:] = end[:-1]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    before[first] = texts.start[row[first]]
    # the library puts one space before a text that is not empty
    spaces = begin - before + (first & (texts.start[row + 1] > texts.start[row]))
    return row, begin, end, kind, hashed, spaces


#: Words a worker remembers at most, by model: hashes in order, where their ids begin, how many, all ids,
#: and how often each word was met.
REMEMBERED = 250_000
_memory: dict[str, tuple[np.ndarray, ...]] = {}


def _nothing() -> tuple[np.ndarray, ...]:
    return (
        np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
    )


def _common_half(keys: np.ndarray, begins: np.ndarray, sizes: np.ndarray, ids: np.ndarray, met: np.ndarray) -> tuple:
    """What to remember of too many words: the more frequent half, older meetings counted half."""
    keep = np.sort(np.argpartition(-met, REMEMBERED // 2)[: REMEMBERED // 2])
    kept = ids[_spread(begins[keep], sizes[keep])]
    size = sizes[keep]
    return keys[keep], np.cumsum(size) - size, size, kept, met[keep] // 2


def encode_column(model: Model, column: pa.Array) -> pa.Array:
    """Ids of each text: the library's encoding.

    Every distinct word is matched once; a worker remembers those of earlier batches.
    """
    known = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), SPACE, " ")
    keys, begins, sizes, ids, met = _memory.get(model.name, _nothing())
    blocks = []
    new: dict[int, str] = {}
    for texts in parts(known, PART_BYTES):
        row, begin, end, kind, hashed, spaces = _stops(texts)
        word = kind == 0
        # the same letters with and without a space before them are two units
        unit = np.where(spaces > 0, hashed, mix(hashed))
        at = np.flatnonzero(word)
        order = np.argsort(unit[at])
        fresh = unit[at[order]]
        some = np.append(True, fresh[1:] != fresh[:-1])[: len(fresh)]
        # which of the distinct units each word is
        which = np.empty(len(at), np.int32)
        which[order] = np.cumsum(some, dtype=np.int32) - 1
        fresh, at = fresh[some], at[order[some]]
        different = fresh
        if len(keys):
            some = keys[np.minimum(np.searchsorted(keys, fresh), len(keys) - 1)] != fresh
            fresh, at = fresh[some], at[some]
        raw = texts.data.tobytes()
        spans = zip(fresh.tolist(), begin[at].tolist(), end[at].tolist(), (spaces[at] > 0).tolist(), strict=True)
        for h, b, e, spaced in spans:
            if h not in new:
                new[h] = (SPACE if spaced else "") + raw[b:e].decode("utf-8")
        blocks.append((texts.rows, row.astype(np.int32), kind.astype(np.int8), different, which, spaces.astype(np.int32)))
    met = met.copy()
    if new:
        more, starts = _encode_distinct(model, list(new.values()))
        keys = np.concatenate([keys, np.fromiter(new, np.uint64, len(new))])
        order = np.argsort(keys)
        begins = np.concatenate([begins, starts[:-1] + len(ids)])[order]
        sizes = np.concatenate([sizes, np.diff(starts)])[order]
        met = np.concatenate([met, np.zeros(len(new), np.int64)])[order]
        keys, ids = keys[order], np.concatenate([ids, more])
    longest, newline = model.run_length, model.byte_ids[10]
    short = np.array([len(x) for x in model.short_runs])
    short_ids, short_at = np.concatenate(model.short_runs), np.cumsum(short) - short
    lone = ids[np.minimum(begins, max(len(ids) - 1, 0))] == model.space if len(ids) else np.zeros(0, bool)
    out, counts = [], []
    for rows, row, kind, different, which, spaces in blocks:
        word = kind == 0
        marked = word & (spaces > 0)
        first, size = np.zeros(len(row), np.int64), (kind == 1).astype(np.int64)
        # a space that no merge joins to its word belongs to the spaces before it
        split = np.zeros(len(row), bool)
        if word.any():
            number = np.searchsorted(keys, different)
            met[number] += np.bincount(which, minlength=len(different))
            number = number[which]
            split[word] = lone[number]
            split &= marked
            first[word] = begins[number] + split[word]
            size[word] = sizes[number] - split[word]
        run = spaces.astype(np.int64) - marked + split
        run_ids = run // longest + short[run % longest]
        total = run_ids + size
        place = np.cumsum(total) - total
        tokens = np.empty(int(total.sum()), np.int32)
        some = np.flatnonzero(run_ids)
        whole, rest = run[some] // longest, run[some] % longest
        tokens[_spread(place[some], whole)] = model.run
        tokens[_spread(place[some] + whole, short[rest])] = short_ids[_spread(short_at[rest], short[rest])]
        tokens[place[kind == 1] + run_ids[kind == 1]] = newline
        tokens[_spread((place + run_ids)[word], size[word])] = ids[_spread(first[word], size[word])]
        out.append(tokens)
        counts.append(np.bincount(row, total, rows).astype(np.int64))
    remembered = (keys, begins, sizes, ids, met)
    _memory[model.name] = remembered if len(keys) <= REMEMBERED else _common_half(*remembered)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
    values = np.concatenate(out) if out else np.zeros(0, np.int32)
    mask = column.is_null() if column.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values), mask=mask)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` of each length, one after the other."""
    size = size.astype(np.int64)
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def decode_column(model: Model, column: pa.Array) -> pa.Array:
    """Texts of lists of ids; the space that encoding put first is dropped."""
    lengths = np.array([len(x) for x in model.output], np.int64)
    begins = np.cumsum(lengths) - lengths
    spelled = np.frombuffer(b"".join(model.output), np.uint8)
    texts: list[pa.Array] = []
    at, n = 0, len(column)
    sizes = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    while at < n:
        done = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, done + INDEX_CHARS, "right")), at + 1)
        ids = flat[done : ends[to - 1]]
        data = spelled[_spread(begins[ids], lengths[ids])]
        limit = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[done], ends[at:to]]) - done]
        drop = np.zeros(len(data), bool)
        some = limit[:-1][limit[:-1] < limit[1:]]
        drop[some] = data[some] == 32
        limit = limit - np.concatenate([[0], np.cumsum(drop)])[limit]
        data = data[~drop]
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), to - at, [None, pa.py_buffer(limit.astype(np.int64)), pa.py_buffer(data)]
        )
        try:
            texts.append(raw.cast(pa.string()))
        except pa.ArrowInvalid:  # ids that are not an encoding may cut a character
            texts.append(pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string()))
        at = to
    whole = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
    return pc.if_else(column.is_valid(), whole, pa.scalar(None, pa.string()))


def encoder(model: Model) -> Column:
    """A column function: text to ids."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(column: pa.Array) -> pa.Array:
        ids = encode_column(model, column)
        release()
        return ids

    return encode


def decoder(model: Model) -> Column:
    """A column function: ids to text."""

    @F.arrow_udf(T.StringType())
    def decode(column: pa.Array) -> pa.Array:
        texts = decode_column(model, column)
        release()
        return texts

    return decode


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and the ids; a column named like them is replaced."""
    bounded_batches(docs.sparkSession, ARROW_MB)
    return docs.withColumn(ids_col, encoder(load(path))(F.col(text_col)))


def decode_ids(rows: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the decoded text; a column named like it is replaced."""
    bounded_batches(rows.sparkSession, ARROW_MB)
    return rows.withColumn(text_col, decoder(load(path))(F.col(ids_col)))
