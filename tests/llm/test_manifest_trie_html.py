"""Merkle manifest, prefix trie and main text against plain versions of their definitions."""

import hashlib
import random
import re
import zlib

import pytest

from ledgermatch.llm import main_text, merkle, prefix_trie
from ledgermatch.llm.ranks import ranked

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
TURNS = "conv_id long, turn long, role string, text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out.append((level[a:i], level[i + 1 : a + 16]))
        i //= 16
    return out


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def merkle_brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in groups[s]]) for s in order]
    top, out = tree([t[-1][0] for t in trees]), []
    for j, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            proof = path(trees[j], i) + path(top, j)
            shown = (*r[:4], r[4].translate(LOW)) if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r
            own = leaf(shown)
            for left, right in proof:
                own = H(*left, own, *right)
            out.append((r[0], leaf(r), trees[j][-1][0], top[-1][0], H(*[d for p in proof for side in p for d in side]), own, own == top[-1][0]))
    return out


@pytest.mark.parametrize("hot", [0, 9000])
def test_merkle(spark, hot):
    rnd = random.Random(hot)
    names = ["hot"] * (hot // 10) + [None, "", "é", "z", "Z"] + [f"s{k}" for k in range(30)]
    rows = [(i if i % 97 else None, rnd.choice(names), None if i % 11 == 0 else "en", i % 7, None if i % 13 == 0 else f"T{i % 50}") for i in range(hot + 300)]
    rows += [(7, "z", None, None, "Same")] * 40 + [(8, "one", "en", 1, "X" * 200_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", leaf string, g long")  # clashing names play no part
    got = merkle.verify_documents(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(merkle_brute(rows), key=str)
    assert {r.verified for r in got} == {True, False}


def test_merkle_small(spark):
    one = [(3, None, None, None, None)]
    assert [tuple(r) for r in merkle.verify_documents(spark.createDataFrame(one, DOCS)).collect()] == merkle_brute(one)
    assert merkle.verify_documents(spark.createDataFrame([], DOCS)).collect() == []


def test_ranked(spark):
    rows = [(None if i % 3 else "a", 5 if i % 2 else i) for i in range(2000)]
    got = ranked(spark.createDataFrame(rows, "g string, k long"), ["g"], ["k"]).collect()
    for g in (None, "a"):
        mine = sorted((r.pos, r.k) for r in got if r.g == g)
        assert [k for _, k in mine] == sorted(k for h, k in rows if h == g) and [p for p, _ in mine] == list(range(len(mine)))
    assert {r.n for r in got if r.g == "a"} == {667}


def trie_brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    original = {c: [(v[2], v[3]) for v in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = original.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:]
    nodes, children, leaves, saved = {}, {}, {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        saved[k] = (len(nodes[k]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0) + sum(saved[x] for x in below)
    ends = lambda k, m: H(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)))
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], ends(k, m)) for k, m in nodes.items()), key=str)


def trie_of(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()), key=str)


def test_trie_random(spark):
    rnd, rows = random.Random(3), []
    for c in range(-30, 200):
        if c % 20 == 0 and rnd.random() < 0.3:
            continue
        g = rnd.choice([0] * 5 + list(range(40)))
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9, 30])):
            rows.append((c, t if t else None, ["user", "assistant", None][t % 3], f"g{g} w {t}" if t < 25 else rnd.choice([None, "", "a b"])))
    rows += [(None, 1, "user", "x"), (5, 3, "user", "dup"), (5, 3, "user", "dup"), (7, 9, None, None)]
    rnd.shuffle(rows)
    assert trie_of(spark, rows) == trie_brute(rows)


def test_trie_of_copies_and_long_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    monkeypatch.setattr(prefix_trie, "STRIDE", 8)
    rows = [(c, 0, "u", "same") for c in range(300, 500)] + [(c, t, "u", f"t {t}") for c in (20, 40) for t in range(45)] + [(60, t, "u", f"t {min(t, 40)}") for t in range(44)]
    assert trie_of(spark, rows) == trie_brute(rows)


@pytest.mark.parametrize("rows", [[(20, 1, "u", "x")], [(7, 1, "u", "x")], [(1, 1, "u", "x"), (21, 1, "u", "x")], []])
def test_trie_small(spark, rows):
    assert trie_of(spark, rows) == trie_brute(rows)


PROSE = "It was the best of the days that we had in the town, and all of us were out on the river to see the boats."


def page(body, head=""):
    return f'<!DOCTYPE html><html lang="en"><head><title>no</title>{head}</head><body class="no-sidebar has-comments">{body}</body></html>'


def test_main_text_of_marked_articles():
    body = (
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div id='cookie-banner'>We use cookies.</div>"
        f"<main><article><header><h1>The &lt;Title&gt;</h1></header><p>Short.<p>{PROSE}<br>More\n\t&amp; more&nbsp;here.</p><script>var t='</p>';</script><div class='ad'>{PROSE}</div>"
        "<p>See <a href='x'>the report</a>.</p><ul><li>One<li>Two</ul><table><tr><td>a<td>b</table><form><p>Mail me</p><input value='>'></form><!-- <p>gone</p> -->"
        f"<p><b>Bold<br><p>End</article><section class='comments'><article><p>{PROSE} I think.</p></article></section></main><aside><p>{PROSE}</p></aside><footer>&copy; me</footer>"
    )
    want = ["The <Title>", "Short.", PROSE + " More & more here.", "See the report.", "One", "Two", "a", "b", "Bold", "End"]
    assert main_text.main_text(page(body))[0].split("\n") == want


def test_main_text_among_names():
    """Names of layout don't hold against the article; names of notices, adverts and comments do, in any element."""
    body = (
        f"<div class='page-header'><p>{PROSE}</p></div><div id='leftsidebar'><p>{PROSE}</p></div><div class='content sidebar-right'><article class='post tag-cookie comments-open'><h1>Title</h1>"
        f"<p>{PROSE} <span class='ad-label'>Advert!</span><i class='x'>so</i></p><ins class='advert-slot'>Buy</ins><p>On <em>and</em> on.</p><div class='topnav'><p>{PROSE}</p></div></article>"
        f"<div class='commentlist'><article class='comment'><p>{PROSE}</p></article></div><article class='teaser'><p>{PROSE}</p></article></div><div class='sitefooter'>{PROSE}</div>"
    )
    assert main_text.main_text(page(body))[0].split("\n") == ["Title", PROSE + " so", "On and on."]
    nested = f"<main><div class='sidebar-left wide'><article><p>{PROSE}</p></article></div><div class='sidebar'><article><p>{PROSE} Not this.</p></article></div></main>"
    assert main_text.main_text(page(nested))[0] == PROSE
    replies = f"<main><div class='post'><p>{PROSE}</p></div><div class='comments'><article><p>{PROSE} Not this.</p></article></div></main>"
    assert main_text.main_text(page(replies))[0] == PROSE
    open_ = f"<article><p>{PROSE}<span class='ad'>x<p>After.</p><table><tr><td>1<td>2</table></article>"
    assert main_text.main_text(page(open_))[0].split("\n") == [PROSE, "After.", "1", "2"]


def test_main_text_by_block_figures():
    links = "".join(f"<li><a href='/{i}'>Section number {i} of the site</a></li>" for i in range(6))
    body = f"<div><ul>{links}</ul></div><div><h2>A heading</h2><p>{PROSE}</p><p>Tiny.</p><p>{PROSE} {PROSE}</p></div><div>{links}</div><p>Imprint</p>"
    assert main_text.main_text(page(body))[0].split("\n") == ["A heading", PROSE, "Tiny.", f"{PROSE} {PROSE}"]
    unknown = "Zxq vrlk omnt " * 30
    assert main_text.main_text(page(f"<ul>{links}</ul><p>{unknown}</p>"))[0] == unknown.strip()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<article></article>", ""), ("<article>a<br><br>b</article>", "a b"), ("<article><p>1 < 2 &am &amp 3</article>", "1 < 2 &am & 3"),
        ("<article><p>open <b class='x", "open <b class='x"), ("<article><p title='a>b'>q</p><p hidden>no</p><p style='display: none'>no</p>", "q"), ("<article><script>x", ""),
        ("<article><p>&#xD800; x &#0;", "� x �"), ("<!-- <article>no</article> --><article>y<!--z--></article>", "y"), ("<article><style>p{}</style>k</article>", "k"),
    ],
)
def test_main_text_edges(html, text):
    assert main_text.main_text(html)[0] == text


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", page(f"<article><p>{PROSE * 5000}</p></article>"), "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "v", "<article>é</article>", "z")], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in main_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", PROSE * 5000, len(PROSE) * 5000), (2, None, "", 0), (2, None, "", 0), (0, "v", "é", 1)], key=str)
    assert main_text.extract(pages.limit(0)).collect() == []
