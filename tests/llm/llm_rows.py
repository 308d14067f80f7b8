"""Rows for the tests: a small corpus, and odd rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators might use for columns of their own.
CLASHES = ["n", "row", "raw", "key", "token", "rep", "label", "score", "bin", "shard", "e", "term", "host", "path", "size", "cell", "__key"]


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    """Random texts with exact and near copies, shared passages, ties, blanks and nulls."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéö") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda k: [r.choice(words) for _ in range(k)]
    shared = [say(60), say(55), say(13)]
    rows: list[tuple] = []
    for i in range(n):
        kind = i % 12
        if kind < 5 or not rows:
            w = say(r.randint(1, 160))
        elif kind < 7:
            w = (r.choice(rows)[1] or "").split(" ")
        elif kind < 9:
            w = (r.choice(rows)[1] or "").split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[r.randrange(len(w))] = r.choice(words)
        else:
            w = say(r.randint(0, 40)) + r.choice(shared) + say(r.randint(0, 40))
        text = " ".join(w)
        if kind == 9:
            text += f" mail a.b{i % 3}@x-y.org at 10.0.0.{i} or 4111 1111 1111 1111, +1 (555) 010-99{i % 10}1"
        rows.append((i * 3, text, ["en", "de", None][i % 3], f"src{i % 4}" if i % 9 else "src0", len(text)))
    return rows


def odd_rows() -> list[tuple]:
    return [
        (1_000_001, None, None, None, None), (1_000_002, "", "en", "", 0), (1_000_003, " \t\n ", "en", "src0", 4), (None, "a row without an id but with words in it", "en", "src1", 40),
        (1_000_004, "twice " * 70, "en", "src2", 420), (1_000_004, "twice " * 70, "en", "src2", 420), (1_000_004, "another text of the same id", "en", "src2", 27),
        (1_000_005, "x" * 300_000, "en", "src3", 300_000), (1_000_006, "1" * 100_000 + "+" * 1000 + "." * 1000, "en", "src3", 102_000), (1_000_007, "ab cd " * 30_000, "en", "http://Site.org/one/two", 180_000),
        (1_000_008, "\U0001f600 é ß 東京 " * 40, "en", "src3", 320), (-5, "negative id", "en", "src3", 11),
    ]
