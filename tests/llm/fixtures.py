"""Small tables with every odd case, and plain versions of the rules."""

from __future__ import annotations

import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, words string"


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def prose(seed: int, n: int) -> list[str]:
    """Words without repetition by chance."""
    letters = str.maketrans("0123456789", "ghijklmnop")
    return [hashlib.md5(f"{seed}-{i}".encode()).hexdigest()[:5].translate(letters) for i in range(n)]


def text(seed: int, n: int) -> str:
    words = prose(seed, n)
    return "\n".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


def documents(spark, rows: list[tuple[int | None, str | None]]):
    """Documents with extra columns whose names clash with those that operators add."""
    full = [(i, t, None if i is None else "en", None if i is not None and i % 5 == 0 else f"s{(i or 0) % 3}", None if t is None else len(t), 7, "w") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, white space, non-ASCII, very long, copies, near copies, a null id."""
    base = text(1, 400)
    changed = base.split(" ")
    changed[100] = "changed"
    shared = " ".join(prose(77, 60))
    return [
        (0, None), (1, ""), (2, " \n\t\x0b\x0c\r "), (3, base), (4, base), (5, " ".join(changed)),
        (6, text(2, 30000)), (7, f"{text(3, 80)}\n{shared} {text(4, 50)}"), (8, f"{text(5, 90)} {shared}\n{text(6, 70)}"),
        (9, "Élan été x “quoted” 漢字 テスト é"), (10, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a"),
        (11, shared), (12, "one"), (13, "one two three"), (14, "one two three"), (15, text(7, 60) + "\n" + text(7, 60)),
        (20, base), (None, text(8, 100)), (21, "ONE two Three"), (22, "x" * 5000),
    ]


def spaced(t: str | None) -> list[str]:
    return SPACED.findall(t or "")


def alnum(t: str | None) -> list[str]:
    return ALNUM.findall(lower(t or ""))
