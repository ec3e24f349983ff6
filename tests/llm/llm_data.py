from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 1, size: int = 60) -> list[tuple]:
    """Documents with nulls, empty and long texts, copies and near copies."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "Né", "zu") for b in "abcdefgh"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [None, "", "   \t\n", "one", "two words", "a\x0bb\x0cc d e"]
    for i in range(size):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([3, 20, 90, 200])))
        if i % 5 == 0:
            text = f"{text}\n{passage} {text[:30]}"
        texts.append(text)
        if i % 7 == 0:
            texts += [text, text.replace(" ", "  ") + " end"]
    texts += ["same text in three rows"] * 3
    texts.append(" ".join(rng.choice(words) for _ in range(20_000)))
    ids = rng.sample(range(-50, 1000), len(texts))
    return [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)]


def with_odd_rows(rows: list[tuple]) -> list[tuple]:
    """Also a null id and a row that is there twice."""
    return [*rows, (None, "no id here at all", None, None, None), rows[10]]
