"""Recursive and byte-level kernels in numpy, run by Arrow batch: each has its inverse beside it."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BIAS_CONTEXT, LPC_SHIFT = 32, 27
MAGIC = b"SGW1"


# --- prediction ---------------------------------------------------------------------------------


def bias_cancel(x: np.ndarray, context: int = BIAS_CONTEXT) -> np.ndarray:
    """Each value less the floored mean of the ``context`` values before it (absent ones are zero)."""
    total = np.concatenate([[0], np.cumsum(x)])
    at = np.arange(len(x))
    return x - (total[at] - total[np.maximum(at - context, 0)]) // context


def _side_by_side(rows: list[np.ndarray]) -> np.ndarray:
    """Windows as columns of one table, time downwards; short ones end in zeros."""
    out = np.zeros((max(map(len, rows), default=0), len(rows)), np.int64)
    for k, r in enumerate(rows):
        out[: len(r), k] = r
    return out


def bias_restore_all(rows: list[np.ndarray], context: int = BIAS_CONTEXT) -> list[np.ndarray]:
    """Inverse of ``bias_cancel`` for many windows: one step of time over all of them at once, each from
    the running sums of what is restored so far."""
    y = _side_by_side(rows)
    total = np.zeros((len(y) + 1, len(rows)), np.int64)
    for t in range(len(y)):
        y[t] += (total[t] - total[max(t - context, 0)]) // context
        total[t + 1] = total[t] + y[t]
    return [y[: len(r), k] for k, r in enumerate(rows)]


def bias_restore(r: np.ndarray, context: int = BIAS_CONTEXT) -> np.ndarray:
    return bias_restore_all([r], context)[0]


def lpc_residual(x: np.ndarray, c: np.ndarray, shift: int = LPC_SHIFT) -> np.ndarray:
    guess = np.zeros(len(x), np.int64)
    for k, ck in enumerate(c.tolist()[: max(len(x) - 1, 0)]):
        guess[k + 1 :] += ck * x[: len(x) - k - 1]
    return x - (guess >> shift)


def lpc_restore_all(rows: list[np.ndarray], c: list[np.ndarray], shift: int = LPC_SHIFT) -> list[np.ndarray]:
    """Inverse of ``lpc_residual`` for many windows, each with its own coefficients (as many for all)."""
    order = len(c[0]) if c else 0
    y = np.concatenate([np.zeros((order, len(rows)), np.int64), _side_by_side(rows)])
    back = np.array(c, np.int64).reshape(len(rows), order).T[::-1]  # the oldest value's coefficient first
    for t in range(order, len(y)):
        y[t] += (back * y[t - order : t]).sum(0) >> shift
    return [y[order : order + len(r), k] for k, r in enumerate(rows)]


def lpc_restore(r: np.ndarray, c: np.ndarray, shift: int = LPC_SHIFT) -> np.ndarray:
    return lpc_restore_all([r], [c], shift)[0]


def lpc_coefficients(x: np.ndarray, order: int, shift: int = LPC_SHIFT) -> np.ndarray:
    """Autocorrelation and the Levinson recursion, in fixed point; zeros for a silent signal."""
    x = x.astype(float)
    r = np.array([float(x[: len(x) - k] @ x[k:]) for k in range(order + 1)]) if len(x) > order else np.zeros(order + 1)
    if r[0] <= 0:
        return np.zeros(order, np.int64)
    a, err = np.zeros(order), r[0] * (1 + 1e-9)
    for i in range(order):
        k = (r[i + 1] - a[:i] @ r[i:0:-1]) / err
        a[:i], a[i] = a[:i] - k * a[:i][::-1], k
        err *= 1 - k * k
        if err <= 0:
            break
    return np.round(np.clip(a, -15, 15) * (1 << shift)).astype(np.int64)


def float_coefficients(x: np.ndarray, order: int, first: int = 256) -> np.ndarray:
    """Prediction weights in floating point, from the autocorrelation of the ``first`` values."""
    r = np.array([x[:first][: max(len(x[:first]) - k, 0)] @ x[:first][k:] for k in range(order + 1)], float)
    if r[0] <= 1e-12:
        return np.zeros(order)
    a, err = np.zeros(order), r[0]
    for i in range(order):
        k = (r[i + 1] - a[:i] @ r[i:0:-1]) / err
        a[:i], a[i] = a[:i] - k * a[:i][::-1], k
        err = max(err * (1 - k * k), 1e-10)
    return a


def float_residual(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Values less their prediction; the first ones, before there are as many as weights, as they are."""
    out = x.astype(float)
    if len(x) > len(c):
        out[len(c) :] -= sum(w * x[len(c) - 1 - k : len(x) - 1 - k] for k, w in enumerate(c.tolist()))
    return out


def float_restore_all(rows: list[np.ndarray], c: list[np.ndarray]) -> list[np.ndarray]:
    """Inverse of ``float_residual`` for many windows with as many weights each."""
    order = len(c[0]) if c else 0
    y = np.zeros((max(map(len, rows), default=0), len(rows)))
    for k, r in enumerate(rows):
        y[: len(r), k] = r
    back = np.array(c, float).reshape(len(rows), order).T[::-1]
    for t in range(order, len(y)):
        y[t] += (back * y[t - order : t]).sum(0)
    return [y[: len(r), k] for k, r in enumerate(rows)]


# --- wavelet ------------------------------------------------------------------------------------


def lift(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer 5/3 step: approximation and detail."""
    even, odd = x[0::2], x[1::2]
    right = np.append(even[1:], even[-1:])[: len(odd)]
    d = odd - ((even[: len(odd)] + right) >> 1)
    if not len(d):
        return even.copy(), d
    before = np.concatenate([d[:1], d])[: len(even)]
    after = np.append(d, d[-1:])[: len(even)]
    return even + ((before + after + 2) >> 2), d


def unlift(s: np.ndarray, d: np.ndarray) -> np.ndarray:
    x = np.empty(len(s) + len(d), np.int64)
    if not len(d):
        return s.copy()
    before = np.concatenate([d[:1], d])[: len(s)]
    after = np.append(d, d[-1:])[: len(s)]
    even = s - ((before + after + 2) >> 2)
    x[0::2] = even
    x[1::2] = d + ((even[: len(d)] + np.append(even[1:], even[-1:])[: len(d)]) >> 1)
    return x


def float_lift(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5/3 step without rounding: approximation and detail."""
    even, odd = x[0::2].astype(float), x[1::2].astype(float)
    if not len(odd):
        return even, odd
    d = odd - (even[: len(odd)] + np.append(even[1:], even[-1:])[: len(odd)]) / 2
    before = np.concatenate([d[:1], d])[: len(even)]
    return even + (before + np.append(d, d[-1:])[: len(even)]) / 4, d


def float_unlift(s: np.ndarray, d: np.ndarray) -> np.ndarray:
    if not len(d):
        return s.astype(float)
    x = np.empty(len(s) + len(d))
    x[0::2] = s - (np.concatenate([d[:1], d])[: len(s)] + np.append(d, d[-1:])[: len(s)]) / 4
    x[1::2] = d + (x[0::2][: len(d)] + np.append(x[2::2], x[0::2][-1:])[: len(d)]) / 2
    return x


# --- entropy coding -----------------------------------------------------------------------------


def zigzag(v: np.ndarray) -> np.ndarray:
    return np.where(v >= 0, 2 * v, -2 * v - 1)


def unzigzag(z: np.ndarray) -> np.ndarray:
    return np.where(z % 2 == 0, z >> 1, -(z >> 1) - 1)


def rice_encode(v: np.ndarray) -> bytes:
    """k as one byte, n as four, then unary quotients and k-bit remainders as one bit string."""
    z = zigzag(v.astype(np.int64))
    mean = float(z[z > 0].mean()) if z.any() else 0.0
    k = min(int(np.floor(np.log2(mean))), 31) if mean >= 1 else 0
    q = z >> k
    size = q + 1 + k
    end = np.cumsum(size)
    bits = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    start = end - size
    ones = np.repeat(start, q) + (np.arange(int(q.sum())) - np.repeat(np.cumsum(q) - q, q))
    bits[ones] = 1
    for j in range(k):
        bits[start + q + 1 + j] = (z >> (k - 1 - j)) & 1
    return struct.pack("<BI", k, len(z)) + np.packbits(bits).tobytes()


def rice_decode(raw: bytes) -> np.ndarray:
    """Where a code starts follows from the one before, so starts are found by doubling: each round knows
    where twice as many codes later begins."""
    k, n = struct.unpack_from("<BI", raw)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=5))
    zero = np.flatnonzero(bits == 0)
    if not n:
        return np.zeros(0, np.int64)
    at = np.arange(len(bits) + 1)
    stop = np.r_[zero, len(bits)][np.searchsorted(zero, at)]
    jump = np.minimum(stop + 1 + k, len(bits))
    start = np.zeros(1, np.int64)
    while len(start) < n:
        start = np.concatenate([start, jump[start]])
        jump = jump[jump]
    start = start[:n]
    end = stop[start]
    z = (end - start) << k
    for j in range(k):
        z |= bits[end + 1 + j].astype(np.int64) << (k - 1 - j)
    return unzigzag(z)


def frequencies(count: np.ndarray, total: int) -> np.ndarray:
    """Counts scaled to sum to ``total``, 1 for each symbol of the alphabet that does not occur; the most
    frequent takes up the rest, and where that is not enough, the next ones."""
    if total < 2 * len(count):
        raise ValueError("the total is below twice the alphabet")
    seen = count > 0
    shared = total - int((~seen).sum())
    f = np.where(seen, np.maximum(count / max(int(count.sum()), 1) * shared, 1), 1).astype(np.int64)
    for k in np.argsort(-count, kind="stable"):
        rest = total - int(f.sum())
        f[k] += max(rest, 1 - int(f[k]))
    return f


_RANS_BITS, _RANS_LOW = 12, 1 << 23


def rans_encode(symbols: np.ndarray, f: np.ndarray) -> bytes:
    """Range ANS over byte-wise renormalisation; the state ends the string."""
    start = np.concatenate([[0], np.cumsum(f)]).tolist()
    freq, x, out = f.tolist(), _RANS_LOW, bytearray()
    for s in reversed(symbols.tolist()):
        top = ((_RANS_LOW >> _RANS_BITS) << 8) * freq[s]
        while x >= top:
            out.append(x & 0xFF)
            x >>= 8
        x = ((x // freq[s]) << _RANS_BITS) + x % freq[s] + start[s]
    return bytes(out) + struct.pack("<I", x)


def rans_decode(raw: bytes, n: int, f: np.ndarray) -> np.ndarray:
    start = np.concatenate([[0], np.cumsum(f)]).tolist()
    freq, slot = f.tolist(), np.repeat(np.arange(len(f)), f).tolist()
    (x,), at, out = struct.unpack("<I", raw[-4:]), len(raw) - 5, np.empty(n, np.int64)
    mask = (1 << _RANS_BITS) - 1
    for i in range(n):
        s = slot[x & mask]
        out[i] = s
        x = freq[s] * (x >> _RANS_BITS) + (x & mask) - start[s]
        while x < _RANS_LOW and at >= 0:
            x = (x << 8) | raw[at]
            at -= 1
    return out


def runs_encode(v: np.ndarray, cap: int = 255) -> np.ndarray:
    """``(value, length)`` pairs; a run above ``cap`` is several."""
    if not len(v):
        return np.zeros((0, 2), np.int64)
    edge = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    size = np.diff(np.r_[edge, len(v)])
    pieces = -(-size // cap)
    length = np.full(int(pieces.sum()), cap, np.int64)
    length[np.cumsum(pieces) - 1] = size - (pieces - 1) * cap
    return np.c_[np.repeat(v[edge], pieces), length]


# --- packets ------------------------------------------------------------------------------------


def levels_for(n: int, most: int = 3) -> int:
    while most and n < 4 << most:
        most -= 1
    return most


def band_order(rank: int, depth: int, n: int) -> int:
    """Prediction order of a band of ``n`` values: 1 for the two of the deepest split, 2 for the detail
    above, 3 for those before, whose neighbours tell more; fewer where a band is short, none below 3 values.
    Band ``rank`` counts from the first split; ``depth`` is the rank of the approximation."""
    order = 1 if rank >= depth - 1 else 2 if rank == depth - 2 else 3
    if n < 4 * order:
        order = max(1, n // 4)
    return order if n >= 3 and n > order else 0


def encode_window(x: np.ndarray, order: int | None = None) -> bytes:
    """A lossless window packet: wavelet bands, each predicted, bias-cancelled and Rice-coded, with a
    CRC-32 of all before it. Bands have the order of ``band_order``, or all the one that is given."""
    bands, now, depth = [], x.astype(np.int64), levels_for(len(x))
    for _ in range(depth):
        now, d = lift(now)
        bands.append(d)
    out = MAGIC + struct.pack("<IB", len(x), depth)
    for k, b in enumerate([*bands, now]):
        m = band_order(k, depth, len(b)) if order is None else order
        c = lpc_coefficients(b, m)
        body = rice_encode(bias_cancel(lpc_residual(b, c)))
        out += struct.pack("<B", m) + c.astype("<i8").tobytes() + struct.pack("<I", len(body)) + body
    return out + struct.pack("<I", zlib.crc32(out))


def decode_windows(packets: list[bytes]) -> list[np.ndarray]:
    """The windows of many packets; bands of one rank and order are restored side by side."""
    heads, bands = [], {}
    for w, raw in enumerate(packets):
        if raw[:4] != MAGIC:
            raise ValueError("not a window packet")
        if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("the packet's checksum does not match")
        n, depth = struct.unpack_from("<IB", raw, 4)
        at = 9
        heads.append((n, depth))
        for b in range(depth + 1):
            order = raw[at]
            c = np.frombuffer(raw, "<i8", order, at + 1).astype(np.int64)
            (size,) = struct.unpack_from("<I", raw, at + 1 + 8 * order)
            at += 8 * order + 5
            bands.setdefault((b, order), []).append((w, c, rice_decode(raw[at : at + size])))
            at += size
    found: dict[tuple[int, int], np.ndarray] = {}
    for (b, _), these in bands.items():
        back = lpc_restore_all(bias_restore_all([r for _, _, r in these]), [c for _, c, _ in these])
        found |= {(w, b): x for (w, _, _), x in zip(these, back, strict=True)}
    out = []
    for w, (n, depth) in enumerate(heads):
        now = found[w, depth]
        for b in reversed(range(depth)):
            now = unlift(now, found[w, b])
        out.append(now[:n])
    return out


def decode_window(raw: bytes) -> np.ndarray:
    return decode_windows([raw])[0]


def encode_levels(x: np.ndarray, levels: int) -> bytes:
    """A lossy packet: the range, then each value's level by range ANS."""
    lo, span = (float(x.min()), float(x.max() - x.min())) if len(x) else (0.0, 0.0)
    s = np.full(len(x), levels // 2) if span <= 0 else np.clip(np.floor((x - lo) / span * levels), 0, levels - 1).astype(np.int64)
    f = frequencies(np.bincount(s, minlength=levels), 1 << _RANS_BITS) if len(x) else np.zeros(levels, np.int64)
    return struct.pack("<IHdd", len(x), levels, lo, span) + f.astype("<u2").tobytes() + (rans_encode(s, f) if len(x) else b"")


def decode_levels(raw: bytes) -> np.ndarray:
    n, levels, lo, span = struct.unpack_from("<IHdd", raw)
    f = np.frombuffer(raw, "<u2", levels, 22).astype(np.int64)
    s = rans_decode(raw[22 + 2 * levels :], n, f) if n else np.zeros(0, np.int64)
    return lo + (s + 0.5) * (span + 1e-8) / levels


# --- spectra ------------------------------------------------------------------------------------

#: The frequency bands in Hz.
BANDS = {"delta": (0.5, 4.0), "theta": (4.0, 8.0), "alpha": (8.0, 13.0), "beta": (13.0, 30.0), "gamma": (30.0, 45.0)}


def band_prd(x: np.ndarray, y: np.ndarray, rate: float) -> dict[str, float]:
    """PRD within each band from one Fourier transform of each signal."""
    fx, fy = np.fft.rfft(x.astype(float)), np.fft.rfft(y.astype(float))
    at = np.arange(len(fx)) * rate / len(x)
    out = {}
    for name, (lo, hi) in BANDS.items():
        m = (at >= lo) & (at < hi)
        base = np.sqrt((np.abs(fx[m]) ** 2).sum())
        out[name] = float(100 * np.sqrt((np.abs(fx[m] - fy[m]) ** 2).sum()) / base) if base > 1e-12 else 0.0
    return out


def welch(x: np.ndarray, rate: float, size: int = 256) -> np.ndarray:
    """Power spectrum: mean periodogram of half-overlapping Hann windows, each without its mean."""
    size = min(size, len(x))
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    parts = [x[a : a + size] for a in range(0, len(x) - size + 1, max(size // 2, 1))]
    p = np.mean([np.abs(np.fft.rfft((s - s.mean()) * w)) ** 2 for s in parts], axis=0) / (rate * (w**2).sum())
    p[1 : (size + 1) // 2] *= 2
    return p


def psd_divergence(x: np.ndarray, y: np.ndarray, rate: float) -> float:
    """Kullback-Leibler divergence of the normalised spectra; a single sample has no spectrum, so none."""
    if len(x) < 2:
        return 0.0
    p, q = welch(x.astype(float), rate) + 1e-12, welch(y.astype(float), rate) + 1e-12
    p, q = p / p.sum(), q / q.sum()
    return float((p * np.log(p / q)).sum())


def high_pass_all(rows: list[np.ndarray], cutoff: float, rate: float) -> list[np.ndarray]:
    """Second-order Butterworth high-pass, run forward over many windows at once."""
    k = np.tan(np.pi * cutoff / rate)
    norm = 1 / (1 + np.sqrt(2) * k + k * k)
    a1, a2 = 2 * (k * k - 1) * norm, (1 - np.sqrt(2) * k + k * k) * norm
    x = np.concatenate([np.zeros((2, len(rows))), _side_by_side(rows)])
    y = np.zeros_like(x)
    for t in range(2, len(x)):
        y[t] = norm * (x[t] - 2 * x[t - 1] + x[t - 2]) - a1 * y[t - 1] - a2 * y[t - 2]
    return [y[2 : 2 + len(r), k] for k, r in enumerate(rows)]


def high_pass(x: np.ndarray, cutoff: float, rate: float) -> np.ndarray:
    return high_pass_all([x], cutoff, rate)[0]


# --- running them -------------------------------------------------------------------------------


#: Windows that a kernel over many of them holds at once, and their values or bytes (a longer one is held alone).
TOGETHER = 1024
VALUES = 1 << 18


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of parts of a column of windows or packets."""
    size = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)).cumsum()
    at = 0
    while at < len(column):
        past = int(size[at - 1]) if at else 0
        n = int(np.searchsorted(size, past + VALUES, "right")) - at
        yield at, max(min(n, TOGETHER), 1)
        at += max(min(n, TOGETHER), 1)


def _rows(column: pa.Array) -> list:
    """Packets as bytes, windows as arrays cut from one copy; a null is an error."""
    if pa.types.is_binary(column.type):
        return column.to_pylist()
    line = column.flatten().to_numpy(zero_copy_only=True).astype(np.int64)
    cut = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return [line[x:y] for x, y in zip(cut[:-1] - cut[0], cut[1:] - cut[0], strict=True)]


def _column(got: list, to: pa.DataType) -> pa.Array:
    """What a kernel gave, without an object for each value."""
    if pa.types.is_binary(to):
        return pa.array(got, to)
    ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
    line = np.concatenate(got) if got else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(line, to.value_type))


def over_windows(windows: DataFrame, f: Callable, result: str = "samples array<long>", many: bool = False) -> DataFrame:
    """``f`` over each row's ``samples`` (or ``packet``), or with ``many`` over lists of up to ``TOGETHER`` of
    them: windows are independent, so no shuffle is needed and parallelism is that of the input. Each call is a
    Python worker of each task, so steps that follow one another are best one ``f``."""
    name, kind = result.split(" ", 1)
    source = "packet" if "packet" in windows.columns else "samples"
    keep = [c for c in windows.columns if c not in ("samples", "packet")]
    to = pa.binary() if kind == "binary" else pa.list_(pa.float64()) if "double" in kind else pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, n in _slices(whole.column(whole.schema.get_field_index(source))):
                b = whole.slice(at, n)
                rows = _rows(b.column(b.schema.get_field_index(source)))
                got = f(rows) if many else list(map(f, rows))
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), _column(got, to)], [*keep, name])

    schema = ", ".join([*(f"{x.name} {x.dataType.simpleString()}" for x in windows.schema if x.name in keep), result])
    return windows.mapInArrow(run, schema)


# --- more inverses ------------------------------------------------------------------------------

_FIXED = np.array([120_000_000, -40_000_000, 20_000_000, 5_000_000], np.int64)


def fixed_residual(x: np.ndarray) -> np.ndarray:
    """``lpc_residual`` with one set of coefficients."""
    return lpc_residual(x, _FIXED)


def fixed_restore_all(rows: list[np.ndarray]) -> list[np.ndarray]:
    return lpc_restore_all(rows, [_FIXED] * len(rows))


def fixed_restore(r: np.ndarray) -> np.ndarray:
    return lpc_restore(r, _FIXED)


def sparse_encode(v: np.ndarray) -> bytes:
    """Positions of the non-zero values as Rice-coded steps, then the values."""
    at = np.flatnonzero(v)
    steps = rice_encode(np.diff(np.r_[-1, at]) - 1)
    return struct.pack("<II", len(v), len(steps)) + steps + rice_encode(v[at])


def sparse_decode(raw: bytes) -> np.ndarray:
    n, size = struct.unpack_from("<II", raw)
    steps = rice_decode(raw[8 : 8 + size])
    out = np.zeros(n, np.int64)
    out[np.cumsum(steps + 1) - 1] = rice_decode(raw[8 + size :])
    return out


def _turn(a: np.ndarray, b: np.ndarray, angle: float, shift: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Plane rotation as three integer lifting steps, each of which can be undone exactly."""
    p, s = round(np.tan(angle / 2) * (1 << shift)), round(np.sin(angle) * (1 << shift))
    a = a - ((p * b) >> shift)
    b = b + ((s * a) >> shift)
    return a - ((p * b) >> shift), b


def _unturn(a: np.ndarray, b: np.ndarray, angle: float, shift: int = 20) -> tuple[np.ndarray, np.ndarray]:
    p, s = round(np.tan(angle / 2) * (1 << shift)), round(np.sin(angle) * (1 << shift))
    a = a + ((p * b) >> shift)
    b = b - ((s * a) >> shift)
    return a + ((p * b) >> shift), b


def rotate(x: np.ndarray, angle: float = 0.6) -> np.ndarray:
    """Even and odd samples as two channels, rotated against one another."""
    n = len(x) // 2
    out = x.copy()
    out[0 : 2 * n : 2], out[1 : 2 * n : 2] = _turn(x[0 : 2 * n : 2], x[1 : 2 * n : 2], angle)
    return out


def unrotate(x: np.ndarray, angle: float = 0.6) -> np.ndarray:
    n = len(x) // 2
    out = x.copy()
    out[0 : 2 * n : 2], out[1 : 2 * n : 2] = _unturn(x[0 : 2 * n : 2], x[1 : 2 * n : 2], angle)
    return out


def runs_pack(v: np.ndarray) -> bytes:
    """Runs of equal values: their values and lengths, both Rice-coded."""
    r = runs_encode(v)
    head = rice_encode(r[:, 0])
    return struct.pack("<I", len(head)) + head + rice_encode(r[:, 1])


def runs_unpack(raw: bytes) -> np.ndarray:
    (size,) = struct.unpack_from("<I", raw)
    return np.repeat(rice_decode(raw[4 : 4 + size]), rice_decode(raw[4 + size :]))


def window_spectra(x: np.ndarray, y: np.ndarray, size: int, rate: float) -> np.ndarray:
    """Power at the frequencies of a window of ``size`` for a window and what was made of it, one after the other.
    A shorter one is filled up with zeros, so all have the same frequencies; a single sample has no spectrum."""
    n = len(x)
    if n < 2:
        return np.zeros(0)
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    return np.concatenate([np.abs(np.fft.rfft((s - s.mean()) * w, size)) ** 2 / (rate * (w**2).sum()) for s in (x, y)])


def band_ratio(x: np.ndarray, rate: float, high: tuple[float, float] = (8.0, 30.0), low: tuple[float, float] = (0.5, 4.0)) -> float:
    """Mean power in the high band over that in the low one: large in a seizure. A band that a window is too
    short for has next to none; a single sample has no ratio, so 0."""
    if len(x) < 2:
        return 0.0
    p = welch(x.astype(float), rate)
    at = np.arange(len(p)) * rate / min(len(x), 256)
    power = lambda b: float(p[(at >= b[0]) & (at <= b[1])].mean()) if ((at >= b[0]) & (at <= b[1])).any() else 1e-30
    return power(high) / (power(low) + 1e-30)
