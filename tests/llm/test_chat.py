from __future__ import annotations

import hashlib

from tallywork.llm import chat
from tests.llm.conftest import tuples

SCHEMA = "conv_id long, turn long, role string, text string, part string, lines int, line string"


def turns(llm, rows):
    return llm.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows, part_turns=chat.PART_TURNS):
    said = {(c, t, r, x or "") for c, t, r, x in rows if c is not None and r is not None}
    out = []
    for conv in {s[0] for s in said}:
        for who in {s[2] for s in said if s[0] == conv and s[2] != "system"}:
            parts = {}
            digits = lambda s: hashlib.md5(f"{s[2]}|{s[3]}".encode()).hexdigest()[:2]
            for at, (_, _, r, x) in enumerate(sorted((s for s in said if s[0] == conv), key=lambda s: (s[1] is None, s[1] or 0, digits(s), s[2], s[3]))):
                parts.setdefault(at // part_turns, []).append((r, x))
            for part, lines in parts.items():
                rendered, mask, masked = "", [], 0
                for r, x in lines:
                    rendered += "<|im_start|>" + ("system" if r == "system" else "assistant" if r == who else f"user name={r}") + "\n"
                    if r == who:
                        mask.append(f"{len(rendered)}:{len(rendered) + len(x) + 11}")
                        masked += len(x) + 11
                    rendered += x + "<|im_end|>\n"
                out.append((conv, who, part, len(lines), masked, rendered, ",".join(mask)))
    return sorted(out, key=repr)


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "anna", "Hello é"), (1, 2, "bob", "hi"), (1, 3, "cleo", ""), (1, 4, "anna", "x\ny"),
    (2, 0, "user", "one"), (2, 0, "user", "one"), (2, 0, "user", "two"), (2, 0, "assistant", "tie"), (2, None, "user", "when?"),
    (3, 0, "system", "alone"), (4, 1, "solo", None), (None, 0, "user", "no id"), (5, 0, None, "no role"), (6, -3, "user", "before"), (6, 600, "user", "late"), (6, 601, "assistant", "w " * 50_000),
]


def test_every_participant_is_the_assistant_once(llm):
    assert tuples(chat.rotate(turns(llm, ROWS))) == brute(ROWS)


def test_masks_cover_what_the_participant_says(llm):
    for r in chat.rotate(turns(llm, ROWS)).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",") if s]
        assert sum(b - a for a, b in spans) == r.n_masked
        assert all(r.rendered[:a].endswith("<|im_start|>assistant\n") and r.rendered[a:b].endswith("<|im_end|>\n") for a, b in spans)


def test_long_dialogues_are_cut_into_parts(llm):
    rows = [(1, i, "ab"[i % 2], f"turn {i}") for i in range(500)]
    got = chat.rotate(turns(llm, rows), part_turns=64)
    assert tuples(got) == brute(rows, 64) and got.count() == 16


def test_turns_without_number_and_of_one_number_are_cut_too(llm):
    """Neither meets in one array or window: parts hold 256 turns, positions have no gap."""
    rows = [(1, None, "ab"[i % 2], f"line {i}") for i in range(1_500)] + [(2, 7, "ab"[i % 2], f"line {i}") for i in range(700)] + [(2, 6, "a", "first"), (2, None, "b", "last")]
    got = chat.rotate(turns(llm, rows))
    assert tuples(got) == brute(rows) and max(r.n_turns for r in got.collect()) == chat.PART_TURNS


def test_empty_table(llm):
    assert chat.rotate(turns(llm, [])).count() == 0
