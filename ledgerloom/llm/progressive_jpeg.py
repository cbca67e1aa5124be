"""Progressive JPEG columns: coefficient scans in and out, many images at a time.

``decode_many`` reads SOF2 files of 8-bit samples: every scan (spectral selection and successive approximation,
DC and AC) is accumulated into coefficient arrays, dequantised, inverse-transformed in integer numpy, chroma is
upsampled and the result is a full-resolution RGB tensor.  Restart intervals decode independently of each other, so
they are lanes of one vectorised state machine; files whose scans agree in their parameters share lanes.

``encode_many`` writes coefficients as a 4:2:0 file with all quantisers at 1: DC and AC first scans at Al = 1, then
refinement scans, one restart interval per block.  The unit of this format is the quantised coefficient, so a payload
byte b is stored as coefficient b - 128, 64 to a block in zigzag order: Y blocks first, then Cb, then Cr; a comment
segment holds the payload's size.

Null text counts as empty (a payload of 64 zero bytes); large payloads are encoded and decoded a bounded number of
blocks at a time; equal texts give equal files; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: The zigzag scan order, as row-major positions.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p % 8 if (p // 8 + p % 8) % 2 == 0 else p // 8))))
BLOCKS_AT_ONCE = 2048
LANES_AT_ONCE = 1 << 15
BATCH_BYTES = 1 << 19


# --- Huffman tables: (counts per length 1..16, symbols)


def _table(lengths: dict[int, int]) -> tuple[bytes, bytes]:
    """A table of these code lengths by symbol; they leave the code of all ones free."""
    assert sum(0.5**n for n in lengths.values()) < 1
    return bytes(sum(n == k for n in lengths.values()) for k in range(1, 17)), bytes(sorted(lengths, key=lambda x: (lengths[x], x)))


#: Fixed code lengths, short for what letters and blanks give at Al = 1.
DC_TABLE = _table({s: 4 for s in range(12)})
AC_TABLE = _table({r << 4 | s: 12 for r in range(16) for s in range(1, 11)} | {0: 8, 0xF0: 12} | {4: 1, 3: 3, 6: 3, 2: 4, 5: 4, 1: 7, 7: 8})
REFINE_TABLE = _table({r << 4 | 1: 5 for r in range(16)} | {0: 5, 0xF0: 5})


def _codes(table: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code and length by symbol."""
    code, lengths, values, k = 0, np.zeros(256, np.int64), np.zeros(256, np.int64), 0
    for n in range(1, 17):
        for _ in range(table[0][n - 1]):
            values[table[1][k]], lengths[table[1][k]] = code, n
            code, k = code + 1, k + 1
        code <<= 1
    return values, lengths


def _lookup(table: tuple[bytes, bytes]) -> np.ndarray:
    """Symbol and code length, as symbol * 32 + length, by the next 16 bits."""
    out, code, k = np.full(1 << 16, 16, np.int32), 0, 0
    for n in range(1, 17):
        for _ in range(table[0][n - 1]):
            first = code << (16 - n)
            out[first : first + (1 << (16 - n))] = table[1][k] << 5 | n
            code, k = code + 1, k + 1
        code <<= 1
    return out


# --- writing


_BIT_LENGTH = np.array([int(x).bit_length() for x in range(2049)], np.int32)


def _bit_length(a: np.ndarray) -> np.ndarray:
    return _BIT_LENGTH[a]


def _magnitude(v: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The extra bits of a coefficient of that size."""
    return np.where(v >= 0, v, v + (1 << size) - 1)


def _dc_first(blocks: np.ndarray):
    v = blocks[:, :1] >> 1
    size = _bit_length(np.abs(v))
    code, length = _codes(DC_TABLE)
    return code[size] << size | _magnitude(v, size), length[size] + size


def _dc_refine(blocks: np.ndarray):
    return blocks[:, :1] & 1, np.ones((len(blocks), 1), np.int64)


def _ac_first(blocks: np.ndarray):
    """A slot for each position (zero runs, symbol and extra bits together), and one for the end of the block."""
    a = blocks[:, 1:]
    v = np.sign(a) * (np.abs(a) >> 1)
    code, length = _codes(AC_TABLE)
    at = np.arange(63, dtype=np.int32)
    nz = v != 0
    before = np.maximum.accumulate(np.where(nz, at, -1), axis=1)
    previous = np.concatenate((np.full((len(v), 1), -1, np.int32), before[:, :-1]), 1)
    run, size = at - previous - 1, _bit_length(np.abs(v))
    symbol = (run & 15) << 4 | size
    values, lengths = code[symbol] << size | _magnitude(v, size), length[symbol] + size
    for k in range(int(run.max()) >> 4):
        more = run >> 4 > k
        values = np.where(more, code[0xF0] << lengths | values, values)
        lengths = np.where(more, lengths + length[0xF0], lengths)
    end = before[:, -1:] < 62
    return np.concatenate((np.where(nz, values, 0), np.where(end, code[0], 0)), 1), np.concatenate((np.where(nz, lengths, 0), np.where(end, length[0], 0)), 1)


def _ac_refine(blocks: np.ndarray):
    """A slot for each position: the symbol that covers the stretch starting there, if one does, then the correction bit."""
    a = blocks[:, 1:]
    size = np.abs(a)
    history, fresh = size >> 1 != 0, size == 1
    zero, at = size == 0, np.arange(63, dtype=np.int32)
    zeros = np.cumsum(zero, 1, dtype=np.int32)
    base = np.maximum.accumulate(np.where(fresh, zeros, 0), axis=1)
    since = zeros - np.concatenate((np.zeros((len(a), 1), np.int32), base[:, :-1]), 1)
    last = np.max(np.where(fresh, at, -1), axis=1, keepdims=True)
    event = fresh | (zero & (since > 0) & (since % 16 == 0) & (at < last))
    following = np.minimum.accumulate(np.where(event, at, 63)[:, ::-1], axis=1)[:, ::-1]
    starts = np.concatenate((np.ones((len(a), 1), bool), event[:, :-1]), 1)
    code, length = _codes(REFINE_TABLE)
    where = np.minimum(following, 62)
    is_new = np.take_along_axis(fresh, where, 1)
    symbol = np.where(following == 63, 0, np.where(is_new, (np.take_along_axis(since, where, 1) & 15) << 4 | 1, 0xF0))
    sign = np.take_along_axis(a, where, 1) > 0
    new = (following < 63) & is_new
    values, lengths = np.where(new, code[symbol] << 1 | sign, code[symbol]), length[symbol] + new
    values, lengths = np.where(starts, values, 0), np.where(starts, lengths, 0)
    return np.where(history, values << 1 | (size & 1), values), lengths + history


def _segments(values: np.ndarray, lengths: np.ndarray, files: np.ndarray) -> list[bytes]:
    """Entropy-coded data per file (ascending numbers, one per block): a restart interval for each row of slots."""
    pad = -lengths.sum(1, keepdims=True) % 8
    n = np.concatenate((lengths, pad), 1).ravel()
    value = np.concatenate((values, (1 << pad) - 1), 1).ravel()[n > 0].astype(np.uint64)
    sizes = n.reshape(len(lengths), -1).sum(1) // 8
    n = n[n > 0]
    at = np.cumsum(n) - n
    # slots lie end to end in 64-bit words; those of one word have no bit in common, so their sum is their union
    word, over = at >> 6, (at & 63) + n - 64
    high = np.where(over > 0, value >> np.maximum(over, 0).astype(np.uint64), value << np.maximum(-over, 0).astype(np.uint64))
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    words[word[starts]] = np.add.reduceat(high, starts)
    spill = np.flatnonzero(over > 0)
    words[word[spill] + 1] |= value[spill] << (64 - over[spill]).astype(np.uint64)
    data = words.byteswap().view(np.uint8)[: int(sizes.sum())]
    row = np.repeat(np.arange(len(sizes)), sizes)
    full = data == 255
    before = np.concatenate(([0], np.cumsum(full)))
    stream = np.zeros(len(data) + int(before[-1]) + 2 * len(sizes), np.uint8)
    stream[np.arange(len(data)) + before[:-1] + 2 * row] = data
    stops = np.cumsum(sizes)
    ends = stops + before[stops] + 2 * np.arange(len(sizes))
    first = np.concatenate(([True], files[1:] != files[:-1]))
    number = np.arange(len(files)) - np.maximum.accumulate(np.where(first, np.arange(len(files)), 0))
    stream[ends], stream[ends + 1] = 255, 0xD0 + number % 8
    final = ends[np.append(np.flatnonzero(first)[1:], len(files)) - 1]
    begins = np.append(0, final[:-1] + 2)
    return [stream[b:e].tobytes() for b, e in zip(begins, final)]


def _marker(code: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 255, code, len(body) + 2) + body


def geometry(n_blocks: int) -> tuple[int, int]:
    """Columns and rows of 16 x 16 units, near a square, that hold so many blocks."""
    units = -(-n_blocks // 6)
    cols = min(4095, int(np.ceil(np.sqrt(units))))
    return cols, -(-units // cols)


_SCANS = ((_dc_first, 0, 0, 0, 1), (_ac_first, 1, 63, 0, 1), (_dc_refine, 0, 0, 1, 0), (_ac_refine, 1, 63, 1, 0))


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """One file per payload; payload sizes are positive multiples of 64."""
    shapes = [geometry(len(p) // 64) for p in payloads]
    parts: list[list[list[bytes]]] = [[[] for _ in range(12)] for _ in payloads]
    blocks, owner, kind = [], [], []
    for k, (p, (cols, rows)) in enumerate(zip(payloads, shapes)):
        units = cols * rows
        data = np.frombuffer(p.ljust(384 * units, b"\0"), np.uint8).reshape(-1, 64)
        blocks.append(data)
        owner.append(np.full(len(data), k))
        kind.append(np.repeat(np.arange(3), (4 * units, units, units)))
    data, owner, kind = np.concatenate(blocks), np.concatenate(owner), np.concatenate(kind)
    for c in range(3):
        rows = np.flatnonzero(kind == c)
        for at in range(0, len(rows), BLOCKS_AT_ONCE):
            some = rows[at : at + BLOCKS_AT_ONCE]
            files = owner[some]
            coefficients = data[some].astype(np.int32) - 128
            for s, (scan, *_) in enumerate(_SCANS):
                coded = scan(coefficients)
                for f, piece in zip(np.unique(files).tolist(), _segments(*coded, files)):
                    parts[f][3 * s + c].append(piece)
    out = []
    for payload, (cols, rows), scans in zip(payloads, shapes, parts):
        file = [b"\xff\xd8", _marker(0xFE, struct.pack(">Q", len(payload))), _marker(0xDB, b"\0" + b"\1" * 64)]
        file.append(_marker(0xC2, struct.pack(">BHHB", 8, 16 * rows, 16 * cols, 3) + bytes((1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0))))
        for slot, table in ((0x00, DC_TABLE), (0x10, AC_TABLE), (0x11, REFINE_TABLE)):
            file.append(_marker(0xC4, bytes([slot]) + table[0] + table[1]))
        file.append(_marker(0xDD, struct.pack(">H", 1)))
        for s, (_, first, last, high, low) in enumerate(_SCANS):
            for c in range(3):
                file.append(_marker(0xDA, bytes((1, c + 1, high, first, last, high << 4 | low))))
                file.append(_joined(scans[3 * s + c]))
        file.append(b"\xff\xd9")
        out.append(b"".join(file))
    return out


def _joined(pieces: list[bytes]) -> bytes:
    """The parts of one scan that were coded separately; BLOCKS_AT_ONCE is a multiple of 8, but a file may start within a part."""
    out, count = [], 0
    for k, piece in enumerate(pieces):
        if k:
            out.append(bytes((255, 0xD0 + (count - 1) % 8)))
        if len(pieces) > 1:
            a = np.frombuffer(piece, np.uint8).copy()
            at = np.flatnonzero((a[:-1] == 255) & (a[1:] >= 0xD0) & (a[1:] <= 0xD7))
            a[at + 1] = 0xD0 + (count + np.arange(len(at))) % 8
            piece, count = a.tobytes(), count + len(at) + 1
        out.append(piece)
    return b"".join(out)


# --- reading


class _File:
    """Frame and scans of one file; scan data stays where it is."""

    def __init__(self, data: bytes):
        self.data, self.scans, self.comment = data, [], b""
        quant: dict[int, np.ndarray] = {}
        tables: dict[int, tuple[bytes, bytes]] = {}
        a = np.frombuffer(data, np.uint8)
        ff = np.flatnonzero(a[:-1] == 255)
        after = a[ff + 1]
        marks = ff[(after != 0) & (after != 255) & ((after < 0xD0) | (after > 0xD7))]
        at, restart = 2, 0
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        while True:
            while data[at + 1] == 255:
                at += 1
            code = data[at + 1]
            if code == 0xD9:
                break
            size = struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if code == 0xFE:
                self.comment = body
            elif code == 0xDB:
                while body:
                    wide = body[0] >> 4
                    quant[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.int32)
                    body = body[1 + 64 * (1 + wide) :]
            elif code == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = (body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif code == 0xDD:
                restart = struct.unpack(">H", body)[0]
            elif code == 0xC2:
                bits, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                if bits != 8:
                    raise ValueError("samples of 8 bits only")
                self.parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
            elif 0xC0 <= code <= 0xCF:
                raise ValueError("not a progressive Huffman-coded file")
            elif code == 0xDA:
                n = body[0]
                chosen = [(next(k for k, p in enumerate(self.parts) if p[0] == body[1 + 2 * i]), body[2 + 2 * i]) for i in range(n)]
                first, last, approx = body[1 + 2 * n : 4 + 2 * n]
                end = int(marks[np.searchsorted(marks, at)])
                table = tuple(tables.get(t >> 4, None) if first == 0 else tables[0x10 | (t & 15)] for _, t in chosen)
                self.scans.append((tuple(c for c, _ in chosen), (first, last, approx >> 4, approx & 15, table), restart, at, end))
                at = end
        self.quant = [quant[q] for *_, q in self.parts]
        self.h, self.v = max(p[1] for p in self.parts), max(p[2] for p in self.parts)
        self.units = (-(-self.width // (8 * self.h)), -(-self.height // (8 * self.v)))
        # blocks of each component, with the padding that interleaved scans have
        self.grids = [(self.units[1] * p[2], self.units[0] * p[1]) for p in self.parts]
        self.firsts = np.cumsum([0, *(r * c for r, c in self.grids)])

    def order(self, components: tuple[int, ...]) -> tuple[np.ndarray, int]:
        """Block numbers of a scan in coding order, and blocks per unit."""
        if len(components) == 1:
            k = components[0]
            _, h, v, _ = self.parts[k]
            cols, rows = -(-(-(-self.width * h // self.h)) // 8), -(-(-(-self.height * v // self.v)) // 8)
            if cols == self.grids[k][1]:
                return np.arange(self.firsts[k], self.firsts[k] + rows * cols), 1
            return (self.firsts[k] + np.arange(rows)[:, None] * self.grids[k][1] + np.arange(cols)).ravel(), 1
        my, mx = np.divmod(np.arange(self.units[0] * self.units[1]), self.units[0])
        each = []
        for k in components:
            _, h, v, _ = self.parts[k]
            for y in range(v):
                for x in range(h):
                    each.append(self.firsts[k] + (my * v + y) * self.grids[k][1] + mx * h + x)
        return np.stack(each, 1).ravel(), len(each)

    def slots(self, components: tuple[int, ...]) -> list[int]:
        """The component (by its place in the scan) of each block of a unit."""
        if len(components) == 1:
            return [0]
        return [place for place, c in enumerate(components) for _ in range(self.parts[c][1] * self.parts[c][2])]


class _Bits:
    """Readers at many places of one byte array; codes and extra bits are looked at 32 bits at a time."""

    def __init__(self, data: np.ndarray):
        d = np.concatenate((data, np.full(8, 255, np.uint8))).astype(np.int64)
        n = len(data) + 1
        self.window = d[:n] << 32 | d[1 : n + 1] << 24 | d[2 : n + 2] << 16 | d[3 : n + 3] << 8 | d[4 : n + 4]

    def look(self, at: np.ndarray) -> np.ndarray:
        """The next 32 bits at each place."""
        return (self.window.take(at >> 3, mode="clip") >> (8 - (at & 7))) & 0xFFFFFFFF

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.window.take(at >> 3, mode="clip") >> (39 - (at & 7))) & 1


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << size) >> 1, bits - (1 << size) + 1, bits)


def _lane_dc(bits: _Bits, at, own, state, scan, lut):
    """own: the lanes' coefficients, 64 x lanes; state: their DC predictions."""
    _, _, high, low, _ = scan
    if high:
        own[0] |= bits.bit(at) << low
        return at + 1
    ahead = bits.look(at)
    found = lut[ahead >> 16]
    size, n = found >> 5, found & 31
    state += _extend((ahead << n & 0xFFFFFFFF) >> (32 - size), size)
    own[0] = state << low
    return at + n + size


def _lane_ac_first(bits: _Bits, at, own, eobrun, scan, lut):
    """eobrun: blocks that are still to be skipped."""
    first, last, _, low, _ = scan
    act = np.flatnonzero(eobrun == 0)
    eobrun[eobrun > 0] -= 1
    lanes, flat = own.shape[1], own.reshape(-1)
    k, place = np.full(len(act), first), at[act]
    while len(act):
        ahead = bits.look(place)
        found = lut[ahead >> 16]
        n, s, r = found & 31, (found >> 5) & 15, found >> 9
        end = s == 0
        if end.any():
            eob = end & (r < 15)
            extra = np.where(eob, r, s)
        else:
            eob, extra = None, s
        value = (ahead << n & 0xFFFFFFFF) >> (32 - extra)
        place = place + n + extra
        k = k + r
        if eob is None:
            flat[k * lanes + act] = _extend(value, s) << low
        else:
            put = ~end
            flat[k[put] * lanes + act[put]] = _extend(value[put], s[put]) << low
            eobrun[act[eob]] = (1 << r[eob]) + value[eob] - 1
        k = k + 1
        stay = k <= last if eob is None else ~eob & (k <= last)
        if not stay.all():
            at[act[~stay]] = place[~stay]
            act, k, place = act[stay], k[stay], place[stay]
    return at


def _lane_ac_refine(bits: _Bits, at, own, eobrun, scan, lut):
    first, last, _, low, _ = scan
    ended = eobrun > 0
    need, zeros, pending = ~ended, np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in range(first, last + 1):
        if need.any():
            ask = np.flatnonzero(need)
            ahead = bits.look(at[ask])
            found = lut[ahead >> 16]
            n, s, r = found & 31, (found >> 5) & 15, (found >> 9).astype(np.int64)
            eob = (s == 0) & (r < 15)
            extra = np.where(eob, r, s)
            value = (ahead << n & 0xFFFFFFFF) >> (32 - extra)
            at[ask] += n + extra
            eobrun[ask[eob]] = (1 << r[eob]) + value[eob]
            ended[ask[eob]] = True
            zeros[ask], pending[ask], need[ask] = r, np.where(s > 0, 2 * value - 1, 0), False
        column = own[k]
        old = column != 0
        if old.all():
            own[k] = column + np.sign(column) * (bits.bit(at) << low)
            at += 1
            continue
        own[k] = np.where(old, column + np.sign(column) * (bits.bit(at) << low), 0)
        at += old
        new = ~old & ~ended
        place = new & (zeros == 0)
        own[k][place] = pending[place] << low
        need |= place
        zeros[new] -= 1
    eobrun[ended] -= 1
    return at


def _run_scans(group: list[tuple[_File, int, tuple]], coef: np.ndarray, pick) -> None:
    """One scan of many files (with the number of each file's first block), whose parameters agree."""
    scan = group[0][2][1]
    raw = np.concatenate([np.frombuffer(f.data, np.uint8, e - a, a) for f, _, (_, _, _, a, e) in group] + [np.zeros(1, np.uint8)])
    sizes = np.array([e - a for _, _, (_, _, _, a, e) in group])
    ff = raw[:-1] == 255
    follow = raw[1:]
    stuffed, mark = np.flatnonzero(ff & (follow == 0)), np.flatnonzero(ff & (follow >= 0xD0) & (follow <= 0xD7))
    keep = np.ones(len(raw), bool)
    keep[stuffed + 1] = keep[mark] = keep[mark + 1] = False
    kept = np.concatenate(([0], np.cumsum(keep)))
    starts = np.sort(np.concatenate((np.cumsum(sizes) - sizes, mark + 2)))
    begin = kept[starts] * 8
    bits = _Bits(raw[keep])
    order, count = [], []
    for f, base, (components, _, restart, *_) in group:
        blocks, unit = f.order(components)
        each = restart * unit if restart else len(blocks)
        order.append(blocks + base)
        lanes = -(-len(blocks) // each)
        count += [each] * (lanes - 1) + [len(blocks) - each * (lanes - 1)]
    order, count = np.concatenate(order), np.array(count)
    head = np.cumsum(count) - count
    if len(begin) != len(count):
        raise ValueError("restart intervals are missing")
    luts = [_lookup(t) if t else None for t in scan[4]]
    slots = group[0][0].slots(group[0][2][0])
    for a in range(0, len(count), LANES_AT_ONCE):
        at, n, first = begin[a : a + LANES_AT_ONCE], count[a : a + LANES_AT_ONCE], head[a : a + LANES_AT_ONCE]
        state = np.zeros((len(luts), len(at)), np.int64)
        for b in range(int(n.max())):
            live = np.flatnonzero(n > b)
            slot, blocks = int(slots[b % len(slots)]), order[first[live] + b]
            kept = state[slot, live]
            if scan[0] == 0:
                own = coef[blocks, 0].astype(np.int64)[None]
                at[live] = pick(bits, at[live], own, kept, scan, luts[slot])
                coef[blocks, 0] = own[0]
            else:
                own = np.ascontiguousarray(coef[blocks].T, np.int64)
                at[live] = pick(bits, at[live], own, kept, scan, luts[slot])
                coef[blocks] = own.T
            state[slot, live] = kept


_BASIS = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
_FIXED = np.rint(_BASIS * 2048)


def inverse_transform(coef: np.ndarray) -> np.ndarray:
    """Samples (0..255) of dequantised blocks in row-major order, in whole numbers."""
    n = len(coef)
    # sums stay below 2**53, so that products of doubles are exact
    rows = np.floor((coef.reshape(n * 8, 8).astype(np.float64) @ _FIXED + 128) / 256)
    columns = (rows.reshape(n, 8, 8).transpose(0, 2, 1).reshape(n * 8, 8) @ _FIXED).astype(np.int64)
    return np.clip(((columns + (1 << 13)) >> 14) + 128, 0, 255).astype(np.uint8).reshape(n, 8, 8).transpose(0, 2, 1)


def decode_many(files: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, bytes]]:
    """Per file: the coefficients (blocks x 64, zigzag), the RGB tensor (height x width x 3), and the comment."""
    read = [_File(f) for f in files]
    bases = np.cumsum([0, *(int(f.firsts[-1]) for f in read)])
    coef = np.zeros((int(bases[-1]), 64), np.int16)
    for k in range(max((len(f.scans) for f in read), default=0)):
        groups: dict = {}
        for f, base in zip(read, bases.tolist()):
            if k < len(f.scans):
                layout = tuple(p[1:3] for p in f.parts) if len(f.scans[k][0]) > 1 else ()
                groups.setdefault((f.scans[k][0], f.scans[k][1], layout), []).append((f, base, f.scans[k]))
        for (_, scan, _), group in groups.items():
            _run_scans(group, coef, _lane_dc if scan[0] == 0 else _lane_ac_refine if scan[2] else _lane_ac_first)
    quant = np.concatenate([np.broadcast_to(q, (r * c, 64)) for f in read for q, (r, c) in zip(f.quant, f.grids)]) if read else coef
    samples = np.empty((len(coef), 8, 8), np.uint8)
    for a in range(0, len(coef), BLOCKS_AT_ONCE):
        spread = np.empty((len(coef[a : a + BLOCKS_AT_ONCE]), 64), np.int32)
        spread[:, ZIGZAG] = coef[a : a + BLOCKS_AT_ONCE] * quant[a : a + BLOCKS_AT_ONCE]
        samples[a : a + BLOCKS_AT_ONCE] = inverse_transform(spread)
    out = []
    for f, base in zip(read, bases.tolist()):
        own = coef[base : base + int(f.firsts[-1])]
        planes = []
        for k, (rows, cols) in enumerate(f.grids):
            blocks = samples[base + int(f.firsts[k]) : base + int(f.firsts[k + 1])]
            plane = blocks.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
            _, h, v, _ = f.parts[k]
            planes.append(plane.repeat(f.v // v, 0).repeat(f.h // h, 1)[: f.height, : f.width].astype(np.int32))
        if len(planes) == 3:
            y, b, r = planes[0], planes[1] - 128, planes[2] - 128
            # fixed values: the colour matrix, times 65536
            planes = [y + ((91881 * r + 32768) >> 16), y - ((22554 * b + 46802 * r + 32768) >> 16), y + ((116130 * b + 32768) >> 16)]
        else:
            planes = planes[:1] * 3
        out.append((own, np.clip(np.stack(planes, 2), 0, 255).astype(np.uint8), f.comment))
    return out


def store_payload(payloads: list[bytes]) -> list[bytes]:
    return encode_many(payloads)


def read_payload(coefficients: np.ndarray, comment: bytes) -> bytes:
    return (coefficients + 128).astype(np.uint8).tobytes()[: struct.unpack(">Q", comment)[0]]


def feature(rgb: np.ndarray) -> str:
    """Size, channel sums and a histogram of brightness, all integers."""
    flat = rgb.reshape(-1, 3)
    sums = flat.sum(0, dtype=np.int64).tolist()
    histogram = np.bincount(flat[:, 1] >> 5, minlength=8).tolist()
    return ":".join([f"{rgb.shape[0]}x{rgb.shape[1]}", *map(str, sums), *map(str, histogram)])


RESULT = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _groups(rows, most: int):
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[1])
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def text_media(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (a progressive JPEG) per document: its text's bytes, zero-padded to a multiple of 64."""

    def work(batches):
        for pdf in batches:
            texts = ((i, (t or "").encode()) for i, t in zip(pdf["doc_id"], pdf["text"]))
            for group in _groups(texts, BATCH_BYTES):
                padded = [t.ljust(max(64, -(-len(t) // 64) * 64), b"\0") for _, t in group]
                rows = [(i, len(t), m) for (i, t), m in zip(group, store_payload(padded))]
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "media"]).astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(work, "doc_id long, n_bytes long, media binary")


def tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width and rgb (row-major, 3 bytes a pixel) of progressive JPEGs in a binary column media."""

    def work(batches):
        for pdf in batches:
            for group in _groups(zip(pdf["doc_id"], pdf["media"]), 2 * BATCH_BYTES):
                decoded = decode_many([m for _, m in group])
                rows = [(i, rgb.shape[0], rgb.shape[1], rgb.tobytes()) for (i, _), (_, rgb, _) in zip(group, decoded)]
                yield pd.DataFrame(rows, columns=["doc_id", "height", "width", "rgb"]).astype({"doc_id": "Int64"})

    return media.select("doc_id", "media").mapInPandas(work, "doc_id long, height int, width int, rgb binary")


def digest(media: DataFrame) -> DataFrame:
    """What the stored files hold, read back: payload digests, the file's digest and the tensor's feature."""

    def work(batches):
        for pdf in batches:
            for group in _groups(zip(pdf["doc_id"], pdf["media"], pdf["n_bytes"]), 2 * BATCH_BYTES):
                rows = []
                for (i, m, n), (coefficients, rgb, comment) in zip(group, decode_many([m for _, m, _ in group])):
                    payload = read_payload(coefficients, comment)
                    rows.append((i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(m), hashlib.sha256(m).hexdigest(), feature(rgb)))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    return media.mapInPandas(work, RESULT)
