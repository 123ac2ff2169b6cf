"""Static binary-fuse filters: three places per key, eight bits each, built once and never changed."""

from __future__ import annotations

import numpy as np

ARITY = 3
_HEAD = 4  # seed, segment length, segments, keys


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments for ``n`` keys."""
    length = 1 << max(2, min(int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)), 18))
    spare = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    capacity = int(np.ceil(n * spare)) if n > 1 else 8
    return length, max(1, -(-capacity // length) - (ARITY - 1))


def _places(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments; one row per key."""
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = first.astype(np.int64) * length
    mask = np.uint64(length - 1)
    inside = [(h >> np.uint64(s)) & mask for s in (0, 13, 26)]
    return np.stack([base + i * length + x.astype(np.int64) for i, x in enumerate(inside)], axis=1)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """A filter that holds every one of the 64-bit ``keys`` and about one in 256 others.

    Keys are peeled in rounds: in each, every key that alone uses one of its slots goes.
    Slots are filled in reverse, each so that its key's three slots XOR to its print;
    keys of one round never use each other's slot.  If peeling gets stuck the next
    seed is tried.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    length, segments = _shape(len(keys))
    for attempt in range(200):
        if attempt and attempt % 8 == 0:
            segments += max(1, segments // 8)
        seed = 0x2545F4914F6CDD1D * (attempt + 1) & 0xFFFFFFFFFFFFFFFF
        h = _mix(keys, seed)
        slots = _places(h, length, segments)
        size = (segments + ARITY - 1) * length
        order: list[tuple[np.ndarray, np.ndarray]] = []
        alive = np.arange(len(keys))
        count = np.bincount(slots.ravel(), minlength=size)
        while len(alive):
            own = slots[alive]
            single = count[own] == 1
            free = single.any(axis=1)
            if not free.any():
                break
            gone = alive[free]
            order.append((gone, own[free, single[free].argmax(axis=1)]))
            np.subtract.at(count, slots[gone].ravel(), 1)
            alive = alive[~free]
        if len(alive):
            continue
        table = np.zeros(size, np.uint8)
        prints = _prints(h)
        for gone, slot in reversed(order):
            three = table[slots[gone]]
            table[slot] = 0
            others = three[:, 0] ^ three[:, 1] ^ three[:, 2] ^ np.take_along_axis(
                three, (slots[gone] == slot[:, None]).argmax(axis=1)[:, None], axis=1
            )[:, 0]
            table[slot] = prints[gone] ^ others
        head = np.array([seed, length, segments, len(keys)], np.uint64)
        return head.tobytes() + table.tobytes()
    raise ValueError("no binary-fuse layout found")


def contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` the filter may hold; never False for one it was built from."""
    seed, length, segments, n = (int(v) for v in np.frombuffer(filter_, np.uint64, _HEAD))
    keys = np.asarray(keys, np.uint64)
    if n == 0:
        return np.zeros(len(keys), bool)
    table = np.frombuffer(filter_, np.uint8, offset=8 * _HEAD)
    h = _mix(keys, seed)
    three = table[_places(h, length, segments)]
    return (three[:, 0] ^ three[:, 1] ^ three[:, 2]) == _prints(h)
