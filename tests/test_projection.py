"""Facts of sections and word differences, against what was written and against their own definition."""

import random

from leafgauge.operators import mutate, projection, sequence

SECTION = r"""<!-- source: source.pdf pages 3-9 -->

# Title **bold** [^1]

<!-- p.4 -->
:::turn{role=user label="User"}
Say \*not bold\* and *it* and `code` :chip[High] see [the docs](https://a.b/c) or <https://d.e/>
:::

- one [^2]
- <!-- p.5 -->two
3.  third

<table><tr><td>A<sup>[7]</sup></td><td>x | y</td></tr><!-- p.6 --></table>

| a | b |
|---|---|

> quoted&nbsp;&amp; self- made

<!-- figure p6-1.png skipped: cover -->
![alt](figures/p6.png)

[^1]: see [src](http://s.t) and
    <https://u.v>
[^2]: short

```py
__under__ <b>tag</b> ﬁne ● dot
"""


def test_every_pass():
    got = {}
    for f in projection.project(SECTION):
        got.setdefault(f.kind, []).append((f.page, f.text, f.target))
    assert got["marker"] == [(4, "4", None), (5, "5", None), (6, "6", None)]
    assert got["heading"] == [(3, "Title bold", None)]
    assert got["bold"] == [(3, "bold", None), (6, "under", None), (6, "tag", None)]
    assert sorted(got["link"]) == [(4, "https://d.e/", "https://d.e/"), (4, "the docs", "https://a.b/c"), (6, "https://u.v", "https://u.v"), (6, "src", "http://s.t")]
    assert got["turn_label"] == [(4, "User", None)] and got["chip"] == [(4, "High", None)]
    assert sorted(got["fn_ref"]) == [(3, "1", None), (4, "2", None), (5, "7", None)]
    assert [(p, n) for p, _, n in got["fn_def"]] == [(6, "1"), (6, "2")] and got["fn_def"][1][1] == "short"
    assert [p for p, _, _ in got["item"]] == [4, 5, 5] and got["fig_skip"] == [(6, "p6-1.png", "cover")] and len(got["image"]) == 1
    assert {p for p, _, _ in got["table_page"]} == {5, 6}
    words = [w for _, w, _ in got["token"]]
    assert words[:4] == ["Title", "bold", "User:", "Say"] and "*not" in words and "it" in words and "self-made" in words and "fine" in words and "&" in words and "●" not in words


def test_nothing_and_plain_text():
    assert projection.project("") == [] and [f.kind for f in projection.project("word")] == ["block", "token"]


def test_differences_turn_one_into_the_other():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(30))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(3)] = [rng.choice("abcxyz") for _ in range(rng.randrange(3))]
        out, at = [], 0
        for op, a0, a1, b0, b1 in sequence.differences(a, b):
            assert (op == "delete") == (b0 == b1) and (op == "insert") == (a0 == a1)
            out += a[at:a0] + b[b0:b1]
            at = a1
        assert out + a[at:] == b
    assert sequence.differences(list("same"), list("same")) == []


def test_defects():
    text = "# A heading of words\n\nSome text here. This is a long sentence of words. And an end\n\n- item\n\n<!-- p.1 -->\n"
    assert mutate.mutated(text, "dup-marker", 0).count("<!-- p.1 -->") == 2
    assert "This is" not in mutate.mutated(text, "delete-sentence", 0)
    assert mutate.mutated(text, "drop-image", 0) is None
    assert all((m := mutate.mutated(text, "swap-words", k)) != text and sorted(m.split()) == sorted(text.split()) for k in range(5))
