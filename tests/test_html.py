"""HTML structure: nested and unclosed containers, implied ends, entities, and a random comparison with a plain parser."""

import html as plain
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from matchloom.operators import html, parsing

PAGES = {
    "nested": "<table><tr><td>a<table class='x>y'><tr><td>in 1<td>in 2</table> b</td><td>c</td></tr><tr><td>d</table><p>x</p><TABLE><TR><TH>e</TH></TABLE>",
    "unclosed": "<ul><li>no<ul><table id=1><tr><td>1<td>2<tr><td>3<tbody><tr><th>4<td>5",
    "entities": "<table><tr><td>Per&uacute; &amp; &#67;o&#x2e; &lt;b&gt;&nbsp; &copy;x &ampx &bogus; &amp &#128512;<td>&Omega;&apos;&#0;",
    "hidden": "<!-- <table><tr><td>no</table> --><script>var t = '<table><tr><td>no</table>';</script><table><tr><td>yes <b>bold</b><!-- </table> --></td></tr></table>",
    "rows": "<table><td>first</td><tr></tr><tr><td></td><td> two \n words </tr></table>",
    "none": "no table", "empty": "", "null": None,
}
ROWS = {
    ("nested", 0, 0): ["a b", "c"], ("nested", 0, 1): ["d"], ("nested", 1, 0): ["in 1", "in 2"], ("nested", 2, 0): ["e"],
    ("unclosed", 0, 0): ["1", "2"], ("unclosed", 0, 1): ["3"], ("unclosed", 0, 2): ["4", "5"],
    ("entities", 0, 0): ["Perú & Co. <b> ©x &ampx &bogus; & 😀", "Ω'�"], ("hidden", 0, 0): ["yes bold"],
    ("rows", 0, 0): ["first"], ("rows", 0, 1): [], ("rows", 0, 2): ["", "two words"],
}


def test_table_rows(spark):
    df = spark.createDataFrame([(k, 1, v) for k, v in PAGES.items()], "id string, lugar int, html string")
    got = {(r.id, r.tabla, r.fila): r.celdas for r in parsing.html_rows(df, "html").collect()}
    assert got == ROWS


def test_list_items(spark):
    page = "<ul class=a><li>one<li>two <b>x</b><ol><li>in 1</li><li>in 2</ol> rest</li>\n<li>three</ul><li>outside<ul></ul><ol><li>&eacute;"
    got = {(r.lista, r.item): r.texto for r in parsing.html_list_items(spark.createDataFrame([(page,)], "h string"), "h").collect()}
    assert got == {(0, 0): "one", (0, 1): "two x rest", (0, 2): "three", (1, 0): "in 1", (1, 1): "in 2", (3, 0): "é"}


def test_stat_pairs(spark):
    item = "<li class='{c}'><div class=\"StatBox a\"><div><i>{a}</i></div> <div>%</div></div><span x=1 class=\"TheStatTitle\">{t}<span> &amp; more</span></span><div class='StatBox'>{b}</div>"
    pages = [
        "<ul>" + item.format(c="Stat", a=1, b=2, t="Tiros") + item.format(c="css-Stats x", a=3, b="<div>4</div>", t="Pases") + item.format(c="Other", a=5, b=6, t="No") + "</ul>",
        item.format(c="Stat", a=1, b=2, t="Fuera") + "</li>" + item.format(c="Stat", a=8, b=9, t="Fuera"),
        "<li class=Stat><div class=StatBox>1</div><span class=StatTitle>Solo</span></li>", "", None,
    ]
    got = [r.estadisticas for r in parsing.html_stat_pairs(spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string"), "h").orderBy("i").collect()]
    assert got[0] == {"Tiros & more_local": "1 %", "Tiros & more_visitante": "2", "Pases & more_local": "3 %", "Pases & more_visitante": "4"}
    assert got[1] == {"Fuera & more_local": "8 %", "Fuera & more_visitante": "9"}
    assert got[2] == {} and got[3] == {} and not got[4]


def test_entities_equal_the_standard_ones(spark):
    texts = [f"x &{n}; y &{n if n in plain.entities.html5 else 'lt'} z" for n in sorted(plain.entities.name2codepoint)] + [f"&#{i};&#x{i:X};" for i in (65, 233, 8364, 128512, 1113000)] + ["&", "&&", "a&", "&;", "&#;", "&#x;", "", "&amp;amp;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(html.decoded(F.col("t"))).collect()] == [plain.unescape(t) for t in texts]


class Tables(HTMLParser):
    """Own-level cells of every table, by a stack; rows and cells end where the next one begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.stack = [], []

    def handle_starttag(self, tag, attrs):
        top = self.stack[-1] if self.stack else None
        if tag == "table":
            self.tables.append([])
            self.stack.append([self.tables[-1], False])
        elif top and tag == "tr":
            top[0].append([])
            top[1] = False
        elif top and tag in ("td", "th"):
            if not top[0]:
                top[0].append([])
            top[0][-1].append("")
            top[1] = True
        elif top and tag in ("thead", "tbody", "tfoot"):
            top[1] = False

    def handle_endtag(self, tag):
        if tag == "table" and self.stack:
            self.stack.pop()
        elif self.stack and tag in ("td", "th", "tr", "thead", "tbody", "tfoot"):
            self.stack[-1][1] = False

    def handle_data(self, data):
        if self.stack and self.stack[-1][1]:
            self.stack[-1][0][-1][-1] += data


def page(rnd, depth=0):
    out = rnd.choice(["<table>", "<TABLE border=1>", "<table class='a'>"])
    for _ in range(rnd.randint(0, 3)):
        out += rnd.choice(["<tr>", "<tr class=x>", "<tbody><tr>", "</tr><tr>"])
        for _ in range(rnd.randint(0, 3)):
            out += rnd.choice(["<td>", "<th scope=row>"]) + rnd.choice(["", "a", "b &amp; c", "<i>d</i>", "é "])
            if depth < 3 and rnd.random() < 0.25:
                out += page(rnd, depth + 1)
            out += rnd.choice(["", "</td>", "</th>"])
        out += rnd.choice(["", "</tr>"])
    return out + "</table>"


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    rnd = random.Random(seed)
    pages = ["x" * rnd.randint(0, 1) + "".join(page(rnd) for _ in range(rnd.randint(1, 3))) for _ in range(150)]
    want = {}
    for k, p in enumerate(pages):
        parser = Tables()
        parser.feed(p)
        parser.close()
        want |= {(k, t, r): [" ".join(c.split()) for c in cells] for t, rows in enumerate(parser.tables) for r, cells in enumerate(rows)}
    df = spark.createDataFrame(list(enumerate(pages)), "k int, h string").repartition(4)
    assert {(r.k, r.tabla, r.fila): r.celdas for r in parsing.html_rows(df, "h").collect()} == want
