"""Cuckoo filters on arrays: membership of 64-bit hashes with insertion and deletion."""

from __future__ import annotations

import numpy as np

from .texthash import mix

SLOTS = 4
LOAD = 0.75
_ROUNDS = 400


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each has two possible buckets.

    No inserted hash is ever missed. A hash that was not inserted is found with a chance of about
    2 * 4 / 65535. A full table is not rebuilt: another, larger one is added behind it.
    """

    def __init__(self, expected: int = 0):
        self.tables: list[np.ndarray] = []
        self.aside = np.empty(0, dtype=np.uint64)
        self._grow(expected)

    @classmethod
    def from_bytes(cls, data: list[bytes]) -> CuckooFilter:
        """The filter that to_bytes gave."""
        made = cls()
        made.aside = np.frombuffer(data[0], dtype=np.uint64).copy()
        made.tables = [np.frombuffer(t, dtype=np.uint16).reshape(-1, SLOTS).copy() for t in data[1:]]
        return made

    def to_bytes(self) -> list[bytes]:
        return [self.aside.tobytes(), *(t.tobytes() for t in self.tables)]

    def _grow(self, expected: int) -> None:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, expected) / (SLOTS * LOAD)))))
        self.tables.append(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @staticmethod
    def _mark(hashes: np.ndarray) -> np.ndarray:
        mark = (hashes >> np.uint64(48)).astype(np.uint16)
        return np.where(mark == 0, np.uint16(1), mark)

    @staticmethod
    def _other(bucket: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & np.uint64(buckets - 1)).astype(np.int64)

    def _places(self, table: np.ndarray, hashes: np.ndarray):
        mark = self._mark(hashes)
        first = (hashes & np.uint64(len(table) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark, len(table))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), dtype=bool)
        for number, table in enumerate(self.tables):
            mark, first, second = self._places(table, hashes)
            found |= (table[first] == mark[:, None]).any(1) | (table[second] == mark[:, None]).any(1)
            if len(self.aside):
                found |= np.isin(self._code(number, first, mark), self.aside)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        """Insert each hash once; equal hashes are inserted as often as they are given."""
        while len(hashes):
            table = self.tables[-1]
            room = max(0, int(table.size * LOAD) - int(np.count_nonzero(table)))
            now, hashes = hashes[:room], hashes[room:]
            if len(now):
                self._place(table, now)
            if len(hashes):
                self._grow(2 * max(table.size, len(hashes)))

    def _place(self, table: np.ndarray, hashes: np.ndarray) -> None:
        mark, bucket, _ = self._places(table, hashes)
        random = np.random.default_rng(len(hashes))
        for turn in range(_ROUNDS):
            if not len(mark):
                return
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            head = np.concatenate(([True], bucket[1:] != bucket[:-1]))
            rank = np.arange(len(bucket)) - np.flatnonzero(head)[np.cumsum(head) - 1]
            free = table[bucket] == 0
            fits = rank < free.sum(1)
            slot = np.argmax((np.cumsum(free, axis=1) == (rank + 1)[:, None]) & free, axis=1)
            table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket = mark[~fits], bucket[~fits]
            if turn % 2 and len(mark):  # both buckets are full: one of each bucket takes a slot
                lead = np.concatenate(([True], bucket[1:] != bucket[:-1]))
                at, slot = bucket[lead], random.integers(0, SLOTS, int(lead.sum()))
                evicted = table[at, slot].copy()
                table[at, slot] = mark[lead]
                mark = np.where(lead, 0, mark).astype(np.uint16)
                mark[lead] = evicted
            bucket = self._other(bucket, mark, len(table))
        if len(mark):  # no place after all those turns: kept aside, so nothing is ever missed
            self.aside = np.append(self.aside, self._code(len(self.tables) - 1, bucket, mark))

    def _code(self, number: int, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        low = np.minimum(bucket, self._other(bucket, mark, len(self.tables[number])))
        return np.uint64(number << 56) | (low.astype(np.uint64) << np.uint64(16)) | mark.astype(np.uint64)

    def remove(self, hashes: np.ndarray) -> None:
        """Remove one mark for each hash; only hashes that were inserted may be given.

        The largest table goes first: hashes that share mark and buckets there share them in all smaller ones,
        so whichever of their marks goes, those left serve the others. The reverse does not hold.
        """
        for number, table in reversed(list(enumerate(self.tables))):
            later = []
            while len(hashes):
                # One hash of each mark and pair of buckets at a time: different ones share no slot.
                mark, first, second = self._places(table, hashes)
                code = self._code(number, first, mark)
                lead = np.unique(code, return_index=True)[1]
                gone = np.zeros(len(lead), dtype=bool)
                if len(self.aside):
                    place = np.unique(self.aside, return_index=True)
                    at = np.minimum(np.searchsorted(place[0], code[lead]), len(place[0]) - 1)
                    gone = place[0][at] == code[lead]
                    self.aside = np.delete(self.aside, place[1][at[gone]])
                for bucket in (first[lead], second[lead]):
                    held = (table[bucket] == mark[lead][:, None]) & ~gone[:, None]
                    hit = np.flatnonzero(held.any(axis=1))
                    table[bucket[hit], held[hit].argmax(axis=1)] = 0
                    gone[hit] = True
                # What this table lacks now, it lacks for all hashes alike.
                lacking = np.isin(code, code[lead][~gone])
                later.append(hashes[lacking])
                rest = ~lacking
                rest[lead] = False
                hashes = hashes[rest]
            hashes = np.concatenate([hashes, *later])
