"""Plain loops that say what the operators have to give, and random streams for them."""

import random


def split(line):
    blanks = " \t\n\x0b\f\r"
    parts, token = [], ""
    for char in line:
        if char in blanks:
            parts.append(token)
            token = ""
        else:
            token += char
    parts.append(token)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


class Sums:
    """One key of the resettable sum."""

    def __init__(self):
        self.items, self.latest, self.out, self.averages, self.pairs = [], None, [], [], []
        self.half = []

    def add(self, seq, n):
        if n == -1:
            self.items, self.half = [], []
            return
        self.items.append(n)
        self.latest = sum(self.items)
        self.out.append((seq, n, self.latest))
        if len(self.items) >= 2:
            self.averages.append((seq, sum(self.items) / len(self.items)))
        self.half.append(n)
        if len(self.half) == 2:
            self.pairs.append((seq, sum(self.half) / 2))
            self.half = []


class Words:
    """One key of the vocabulary."""

    def __init__(self):
        self.entries, self.out = [], []

    def add(self, seq, word):
        if self.entries and word == "clearstate":
            self.entries = []
            return
        for entry in self.entries:
            if entry[1] == word:
                entry[0] += 1
                break
        else:
            self.entries.append([1, word])
        self.out.append((seq, word))


def run(kind, rows):
    """Key -> model after all (key, seq, item) rows in order."""
    models = {}
    for key, seq, item in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        models.setdefault(key, kind()).add(seq, item)
    return models


def number_stream(seed, keys=40, length=60, hot=1500, null_key=False):
    """Many short keys and a hot one, interleaved, with clears in runs and stretches."""
    rng = random.Random(seed)
    owners = [k for k in range(keys) for _ in range(rng.randint(1, length))] + [keys] * hot
    rng.shuffle(owners)
    chance = {k: rng.choice([0, 0.02, 0.3, 0.9]) for k in range(keys + 1)}
    chance[keys] = 0.01
    rows, seq = [], -700
    for owner in owners:
        n = -1 if rng.random() < chance[owner] else rng.randint(-50, 50)
        key = None if null_key and owner == keys else owner
        rows.append((key, seq, n))
        seq += rng.choice([1, 1, 1, 2, 40])
    return rows


def word_stream(seed, **sizes):
    rng = random.Random(seed)
    rows = []
    for key, seq, n in number_stream(seed, **sizes):
        clear = n == -1 or rng.random() < 0.1
        rows.append((key, seq, "clearstate" if clear else rng.choice("abcdef")))
    return rows
