import pytest

from strata.llm.html_text import render

NAV = "<div class=nav>menu</div><p>body</p>"


def page(sheet, body=NAV):
    return f"<html><head><style>{sheet}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>So <math><mi>a</mi> <mo>=</mo> <mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds", "So a=1/2 holds"),
        ("<p><math><semantics><mi>x</mi><annotation>TeX x</annotation></semantics></math> is", "x is"),
        (
            "<p>Fig <svg><title>t</title><defs/><g><path d='M0'/><text x=1>Axis <tspan>y</tspan></text>"
            "<text>Axis x</text></g> stray<desc>d</desc></svg> end",
            "Fig Axis y Axis x end",
        ),
        ("<svg/><p>after", "after"),
        ("<svg><text display=none>a</text><text>b</text></svg>", "b"),
    ],
)
def test_formulas_and_drawings(html, want):
    assert render(html) == want


@pytest.mark.parametrize(
    ("sheet", "shown"),
    [
        ("@media print { .nav { display:none } }", True),
        ("@media (max-width: 600px) { p {color:red} .nav { display:none } }", True),
        ("@media print { .x { color:red } } .nav { display:none }", False),
        ("@supports (display:grid) { @media screen { .nav { display:none } } }", True),
        ("@media screen { .nav { display:none } }", False),
        ("@media all, print{.nav{display:none}}", False),
        ("@layer base { .nav { display:none } }", False),
        ("@import 'x.css'; .nav { display:none }", False),
        (".nav { display:none } .nav { display:block }", True),
        (".nav { display:block } .nav { display:none }", False),
        (".nav { display:none } .nav { visibility:visible }", False),
        (".nav { display:none } div { display:block }", False),
        (".nav { display:none !important } .nav { display:block }", False),
        ("div { display:none } .nav { display:flex }", True),
    ],
)
def test_rules_that_hold(sheet, shown):
    assert render(page(sheet)) == ("menu\n\nbody" if shown else "body")


def test_inline_style_and_media_of_a_sheet():
    assert render(page(".nav{display:none}", "<div class=nav style='display:block'>a</div>b")) == "a\nb"
    assert render("<style media=print>.nav{display:none}</style>" + NAV) == "menu\n\nbody"
