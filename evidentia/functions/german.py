"""The published Snowball stemmer for German."""

from __future__ import annotations

VOWELS = "aeiouyäöü"
S_BEFORE, ST_BEFORE = "bdfghklmnrt", "bdfghklmnt"


def _regions(word: str) -> tuple[int, int]:
    """Where R1 and R2 begin; R1 leaves at least three letters before it."""

    def after(start: int) -> int:
        for i in range(start + 1, len(word)):
            if word[i] not in VOWELS and word[i - 1] in VOWELS:
                return i + 1
        return len(word)

    first = after(0)
    return max(first, 3), after(first)


def stem(word: str) -> str:
    word = word.lower().replace("ß", "ss")
    letters = list(word)
    for i in range(1, len(letters) - 1):  # u and y between vowels are consonants
        if letters[i] in "uy" and letters[i - 1] in VOWELS and letters[i + 1] in VOWELS:
            letters[i] = letters[i].upper()
    word = "".join(letters)
    r1, r2 = _regions(word)

    def ends(*suffixes: str) -> str | None:
        return next((s for s in sorted(suffixes, key=len, reverse=True) if word.endswith(s)), None)

    found = ends("em", "ern", "er", "e", "en", "es", "s")
    if found and len(word) - len(found) >= r1:
        if found != "s":
            word = word[: -len(found)]
            if found in ("e", "en", "es") and word.endswith("niss"):
                word = word[:-1]
        elif word[-2:-1] and word[-2] in S_BEFORE:
            word = word[:-1]
    found = ends("en", "er", "est", "st")
    if found and len(word) - len(found) >= r1 and (found != "st" or len(word) >= 6 and word[-3] in ST_BEFORE):
        word = word[: -len(found)]
    found = ends("end", "ung", "ig", "ik", "isch", "lich", "heit", "keit")
    if found and len(word) - len(found) >= r2:
        before = word[: -len(found)]
        if found in ("end", "ung"):
            word = before
            if word.endswith("ig") and not word.endswith("eig") and len(word) - 2 >= r2:
                word = word[:-2]
        elif found in ("ig", "ik", "isch"):
            word = word if before.endswith("e") else before
        elif found in ("lich", "heit"):
            word = before
            if word.endswith(("er", "en")) and len(word) - 2 >= r1:
                word = word[:-2]
        else:
            word = before
            for more in ("lich", "ig"):
                if word.endswith(more) and len(word) - len(more) >= r2:
                    word = word[: -len(more)]
                    break
    return word.lower().translate(str.maketrans("äöü", "aou"))
