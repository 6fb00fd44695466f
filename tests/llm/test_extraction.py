"""Main text of pages: what the path ratios select."""

import random
import re
import time

from weftline.llm.extraction import PathRatios, _likeness, _smooth, main_text, read_page

SENTENCES = "One long sentence, with marks; and a few more words. It goes on, and it ends here."


def test_ratios_select_on_pages_with_an_article():
    page = f"""<body><div class="lead"><p>{SENTENCES}</p></div><div class="by">Bob</div>
    <article><h1>Head</h1><p>{SENTENCES}</p><p>{SENTENCES}</p><ul><li>Eggs</li><li>Milk</li></ul></article>
    <div class="more"><h2>Elsewhere</h2><span>Go on</span></div></body>"""
    assert main_text(page).split("\n") == [SENTENCES, "Head", SENTENCES, SENTENCES, "Eggs", "Milk"]


def test_skipped_parts_inside_a_block_leave_its_text():
    for part in ('<span class="ad">Ad</span>', "<button>Share</button>", "<select><option>All</select>", '<a class="share" href="/s">Share</a>', "<svg><path d=''/></svg>"):
        for page in (f"<article><p>{part}{SENTENCES}</p></article>", f"<div><p>{SENTENCES}</p><p>{part} {SENTENCES} {part}</p></div>"):
            assert set(main_text(page).split("\n")) == {SENTENCES}
    assert main_text(f'<div class="ad"><p>Ad</p><span>All</span></div><p hidden>No</p><p>{SENTENCES}</p>') == SENTENCES


def test_only_attributes_of_their_exact_name_mark_noise():
    for tag in ('p title="a hidden valley"', "p data-hidden=false", 'p data-id="ad-1"', 'p data-class=ad', "p aria-hidden=false", 'p title="class=ad"', "p data-x='id=\"ad\"'"):
        assert main_text(f"<article><{tag}>{SENTENCES}</p></article>") == SENTENCES
    assert main_text(f'<article><p><a href="/hidden-gems">{SENTENCES}</a></p></article>') == SENTENCES
    for tag in ("p hidden", 'p HIDDEN=""', "p class='big ad'", "p id=ad-1", "p role = banner", 'p style="Display : none"', 'p aria-hidden="true"'):
        assert main_text(f"<article><p>{SENTENCES}</p><{tag}>No</p></article>") == SENTENCES


def test_text_outside_of_article_elements_stays():
    long = " ".join([SENTENCES] * 4)
    teasers = "".join(f"<article><h3>Read {k}</h3><p>More of it soon.</p></article>" for k in range(4))
    body = f'<div class="post"><h1>Head</h1><p>{long}</p><p>{long}</p></div>'
    found = main_text(f"<body>{body}<div class='rest'>{teasers}</div></body>")
    assert found.startswith(f"Head\n{long}\n{long}") and "More of it" not in found
    comment = f'<article class="comment"><p>{SENTENCES}</p></article><article id="related-7"><p>{SENTENCES}</p></article>'
    assert main_text(f"<body>{body}{comment}</body>") == f"Head\n{long}\n{long}"
    for name in ("post has-sidebar", "no-comments", "post tag-login", "comments-open"):
        assert main_text(f'<article class="{name}"><p>{SENTENCES}</p></article>') == SENTENCES


def test_ratios_decide_where_nothing_is_marked():
    menu = "<div class='x1'><ul>" + "".join(f"<li><a href='/{k}'>Part {k}</a></li>" for k in range(9)) + "</ul></div>"
    links = "<div class='x2'>" + "".join(f"<span><a href='/{k}'>{SENTENCES}</a></span>" for k in range(3)) + "</div>"
    body = f"<div class='x3'><h1>Head</h1><p>{SENTENCES}</p><p>{SENTENCES} {SENTENCES}</p></div>"
    page = f"<body>{menu}{links}{body}<div class='x4'><span>All rights</span></div></body>"
    text = f"Head\n{SENTENCES}\n{SENTENCES} {SENTENCES}"
    assert main_text(page) == text
    assert main_text(page, PathRatios(threshold=0)) != text
    assert main_text(page, PathRatios(link=0)).count(SENTENCES) == 6
    assert main_text(page, PathRatios(article=1)) != text


def test_marks_of_a_wrapper_leave_the_choice_to_ratios():
    inner = f"<nav><a href='/'>Home</a></nav><h1>Head</h1><p>{SENTENCES}</p><p>{SENTENCES}</p><div class='comments'><p>{SENTENCES}</p></div>"
    text = f"Head\n{SENTENCES}\n{SENTENCES}"
    for wrapper in ("form method=post", "div class='widget'", "div id=banner"):
        assert main_text(f"<body><{wrapper}>{inner}</{wrapper.split()[0]}><footer>Terms</footer></body>") == text
    assert main_text("<nav>Home, all.</nav><div class='ad'>Buy it, now.</div><footer>Terms.</footer>") == ""


def test_scores_against_plain_loops():
    draw = random.Random(3)
    for _ in range(60):
        html = "<main>" + "".join(
            f"<{tag} class={name}>{text}</{tag}>"
            for tag, name, text in (
                (draw.choice(["div", "p", "section", "nav"]), draw.choice(["a", "b", "ad"]), "Words, so. " * draw.randint(0, 9)) for _ in range(draw.randint(1, 12))
            )
        )
        page, method = read_page(html), PathRatios(article=0, neighbour=draw.choice([0, 0.1, 0.3]), threshold=draw.choice([0.3, 0.6, 0.9]))
        texts = [" ".join(p.raw for p in b.parts).strip() for b in page.blocks]
        found = re.findall(r"<(\w+) class=(\w+)>([^<]*)<", html)
        rows = [((tag, name), text.strip(), 0.01 ** ((tag == "nav") + (name == "ad") > 0)) for tag, name, text in found if text.strip()]
        assert [t for t in texts if t] == [t for _, t, _ in rows]
        order = list(dict.fromkeys(k for k, _, _ in rows))
        if not any(w == 1 for _, _, w in rows):  # every text is marked
            continue
        own = {k: next(w for key, _, w in rows if key == k) for k in order}
        score = dict.fromkeys(order, 0.0)
        for count in (len, lambda t: t.count(",") + t.count(".")):
            each = {k: own[k] * sum(count(t) for key, t, _ in rows if key == k) / sum(key == k for key, _, _ in rows) for k in order}
            smooth = {}
            for i, k in enumerate(order):
                # half of each path is the same
                smooth[k] = each[k] + sum(method.neighbour / 2 * (each[order[j]] - each[k]) for j in (i - 1, i + 1) if 0 <= j < len(order))
            top = max(smooth.values())
            for k in order:
                score[k] += own[k] * smooth[k] / top / 2
        whole = sum(own[k] * len(t) for k, t, _ in rows)
        least = method.threshold * sum(score[k] * own[k] * len(t) for k, t, _ in rows) / whole
        margin = min(abs(s - least) for s in score.values())
        if margin > 1e-9:
            assert main_text(html, method) == "\n".join(t for k, t, _ in rows if score[k] >= least)


def test_smoothing_follows_likeness_of_paths():
    page = read_page("<div><p>one</p><span class=ad>x</span></div><div><h2>two</h2></div><section>three</section>")
    number = {label: k for k, label in enumerate(page.labels)}
    depth = [0] * len(page.parents)
    for k in range(1, len(depth)):
        depth[k] = depth[page.parents[k]] + 1
    assert _likeness(page, number["p."], number["h2."], depth) == 0.5
    assert _likeness(page, number["p."], number["div."], depth) == 0.5
    assert _likeness(page, number["p."], number["section."], depth) == 0
    assert _smooth([4.0, 0.0, 2.0], [0.0, 0.25, 0.5]) == [3.0, 2.0, 1.0]


def test_deep_and_unclosed_pages_take_linear_time():
    body = f"<article><p>{SENTENCES}</p></article>"
    for part in ("<div>", "<b>", "<p><b>", "<div>word ", "<article>", "<li>", "<table><tr><td>", "<a href=x>", "<span class=ad>"):
        page = part * (1_000_000 // len(part))
        begun = time.monotonic()
        assert SENTENCES in main_text(body + page)
        assert time.monotonic() - begun < 60
    assert main_text(f"<script>'<!--'</script>{body}") == SENTENCES
