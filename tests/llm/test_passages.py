"""Parts of benchmark items, items with other white space, and short items."""

import random

import pyarrow as pa

from weftline.llm import decontamination
from weftline.llm.common import text_bytes
from weftline.llm.decontamination import EditBudget, Searcher

draw = random.Random(11)
WORDS = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 7))) for _ in range(400)]


def words(count):
    return " ".join(draw.choice(WORDS) for _ in range(count))


def search(items, *texts):
    return [tuple(r) for r in Searcher(list(enumerate(items)), EditBudget()).search(*text_bytes(pa.array(texts)))]


def test_parts_of_long_items_are_found():
    items = [words(60) for _ in range(5)]
    budget = EditBudget()
    least = budget.window + budget.step - 1
    for k, item in enumerate(items):
        for start, end in ((0, len(item) * 8 // 10), (len(item) // 5, len(item)), (37, 37 + least), (101, 101 + 2 * least)):
            part = item[start:end]
            edited = list(part)
            for p in range(9, len(part), 20):
                edited[p] = "#"
            for quote in (part, "".join(edited)):
                before = words(9) + " ~ "
                ((t, found, a, b, edits),) = search(items, before + quote + " ~ " + words(9))
                assert (t, found) == (0, k) and edits <= 0.15 * len(part)
                assert abs(a - len(before)) <= 16 and abs(b - len(before) - len(quote)) <= 16
    assert search(items, items[0][:60] + " ~ " + words(20), words(300)) == []


def test_whole_items_and_their_parts_in_one_text():
    item = words(50)
    text = f"{item} ~ {words(30)} ~ {item[: len(item) * 7 // 10]} ~"
    found = search([item], text)
    assert found[0][2:] == (0, len(item), 0) and len(found) == 2 and text[found[1][2] :].startswith(item[:90])


def test_white_space_is_one_space():
    item = words(30)
    for text in (item.replace(" ", "  "), item.replace(" ", "\n    "), item.replace(" ", " \t")):
        assert search([item], f"so  {text}  end") == [(0, 0, 4, 4 + len(text), 0)]
        assert search([f" {text}\n"], item) == [(0, 0, 0, len(item), 0)]
    assert search([item], "so  ", f"  {item}", None, "") == [(1, 0, 2, 2 + len(item), 0)]


def test_short_items_are_found_as_they_are():
    items = ["Seven wise men look", "fox 12", "", " \n", "ab", "ñu"]
    assert search(items, "so seven  wise\nmen LOOK at a FOX  12, a cab or abc") == [(0, 0, 3, 23, 0), (0, 1, 29, 36, 0)]
    assert search(items, "seven wise man look at fox 123 or xab", "ab", "bañu ñu") == [(1, 4, 0, 2, 0), (2, 5, 6, 9, 0)]


def least_edits(part, text):
    """Plain dynamic programming: the least edits that turn the part into a piece of the text."""
    row = [0] * (len(text) + 1)
    for i, wanted in enumerate(part, 1):
        last, row[0] = row[0], i
        for j, seen in enumerate(text, 1):
            last, row[j] = row[j], min(last + (wanted != seen), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_windows_against_plain_alignment():
    budget = EditBudget()
    most, hits = budget.edits(budget.window), 0
    for share in range(3, 17):
        item = words(40)[:150].strip()
        part = list(item[24:124])
        for p in draw.sample(range(len(part)), share):
            part[p] = draw.choice(["", "#", part[p] + "~"])
        text = f"{words(6)} = {''.join(part)} = {words(6)}"
        begins = sorted({*range(0, len(item) - budget.window, budget.step), len(item) - budget.window})
        want = min(least_edits(item[b : b + budget.window], text) for b in begins) <= most
        want = want or least_edits(item, text) <= budget.edits(len(item))
        assert bool(search([item], text)) == want
        hits += want
    assert 3 <= hits < 14


def test_hits_in_small_blocks_give_the_same(monkeypatch):
    items = [words(50), "-" * 60, "=" * 130, words(8)]
    texts = [f"{words(40)} {items[0][20:200]} {'-' * 200} {words(9)}", f"{'=' * 400} {items[3]}", items[0], "-" * 59]
    want = search(items, *texts)
    monkeypatch.setattr(decontamination, "_HITS", 37)
    assert search(items, *texts) == want and {r[1] for r in want} == {0, 1, 2, 3}


def test_one_character_all_over_a_long_text():
    found = search(["-" * 60, "-" * 120], "-" * 60_000)
    for item in (0, 1):
        spans = sorted((start, end) for _, k, start, end, _ in found if k == item)
        assert len(spans) > 300 and all(a[1] <= b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))


def test_items_beyond_the_whole_bound_are_joined_from_windows():
    item = words(3000)
    assert len(item) > 2 * EditBudget().whole
    before = words(20) + " ~ "
    assert search([item], f"{before}{item} ~ {words(20)}") == [(0, 0, len(before), len(before) + len(item), 0)]
    half = item[3000:9000]
    ((_, _, start, end, edits),) = search([item], f"{before}{half} ~ {words(20)}")
    assert abs(start - len(before)) <= 16 and abs(end - len(before) - len(half)) <= 16 and edits <= 32
