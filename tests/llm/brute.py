"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re


def repeats_removed(docs: dict[int, str | None], width: int = 100) -> dict[int, tuple]:
    """doc_id to (n_bytes, n_removed, n_spans, sha256 of what is kept)."""
    seen: set[bytes] = set()
    out = {}
    for doc_id in sorted(docs):
        raw = (docs[doc_id] or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - width + 1):
            piece = raw[at : at + width]
            if piece in seen:
                gone[at : at + width] = b"\x01" * width
            seen.add(piece)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_duplicates(docs: dict[int, str | None]) -> dict[int, tuple]:
    """doc_id to (n_shingles, component_id, kept)."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for doc_id, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        if len(words) < 5:
            sets[doc_id] = {tuple(words)} if words else set()
        else:
            sets[doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    links = {d: [] for d in docs}
    for a in docs:
        for b in docs:
            shared = len(sets[a] & sets[b])
            if a != b and sets[a] and 100 * shared >= 75 * len(sets[a] | sets[b]):
                links[a].append(b)
    lowest = reachable(links)
    return {d: (len(sets[d]), lowest[d], lowest[d] == d) for d in docs}


def reachable(links: dict[int, list[int]]) -> dict[int, int]:
    """The smallest id that links reach, for each id."""
    lowest: dict[int, int] = {}
    for start in sorted(links):
        todo = [start]
        while todo:
            at = todo.pop()
            if at not in lowest:
                lowest[at] = start
                todo.extend(links[at])
    return lowest
