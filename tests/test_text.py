"""Text functions against Python's own regular expressions and URL parser."""

import random
import re
import time
from urllib.parse import urlparse

from probelake import fixed
from probelake.functions import text

TITLE = re.compile(fixed.TITLE_PATTERN, re.IGNORECASE | re.DOTALL)
META = re.compile(fixed.META_TITLE_PATTERN, re.IGNORECASE | re.DOTALL)
# The path part is repeated once only: nested repeats match the same and take exponential time in Python.
URL = re.compile(fixed.URL_PATTERN.replace("*)*", "*)"), re.ASCII)
PIECES = [
    "<title", "<TITLE>", "<Title lang='x'\n>", "</title>", "</TITLE>", ">", "<", "a", "é\n", "<meta ",
    '<META property="og:title" ', 'property="og:title"', 'content="', '"', 'content="x y"', "'", " ", "&amp;",
    'PROPERTY="OG:Title"', "Content=", "=", "metaproperty=",
]


def pages(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 18))) for _ in range(n)]


def first_group(pattern, body):
    match = pattern.search(body)
    return match.group(1) if match else ""


def test_page_title_is_the_first_lazy_match(values):
    bodies = pages(4000, 1)
    expected = [first_group(TITLE, b) for b in bodies]
    assert values(bodies, text.page_title) == expected
    assert sum(map(bool, expected)) > 100


def test_meta_title_is_the_first_lazy_match(values):
    bodies = pages(12_000, 2)
    expected = [first_group(META, b) for b in bodies]
    assert values(bodies, text.meta_title) == expected
    assert sum(map(bool, expected)) > 100


def test_title_edges(values):
    bodies = [
        None, "", "no tag", "<TITLE>a\nb</TITLE>", "<title>1</title><title>2</title>", "<titlefoo>x</title>",
        "<title>open", "<title></title>", "<title>&amp;</title>",
    ]
    assert values(bodies, text.page_title) == ["", "", "", "a\nb", "1", "x", "", "", "&amp;"]


def test_titles_of_broken_pages_take_one_pass(values):
    bodies = ["<title>" * 300_000, "<title " * 300_000, '<meta property="og:title" ' * 100_000]
    start = time.time()
    assert values(bodies, text.page_title) == ["", "", ""]
    assert values(bodies, text.meta_title) == ["", "", ""]
    assert time.time() - start < 30


def test_title_behind_a_very_long_page(values):
    body = "x" * 3_000_000 + "<title>" + "y" * 1_000_000 + "</title>"
    assert [len(t) for t in values([body], text.page_title)] == [1_000_000]


def test_network_location(values):
    urls = [
        "http://u:p@H.com:80/a?b#c", "www.x.com/p", "//h/p", "http:///x", "https://a.b", "HTTP://Host?q",
        "ftp://h#f", "", " http://lead.com/x", "ht\ntp://br\token.com/", "http://[::1]:8080/x",
        "mailto:a@b.c", "1http://x/", "a+b.c-d://y/z", "http:/one/slash", "http://ü.example/",
    ]
    assert values(urls, text.network_location) == [urlparse(u).netloc for u in urls]


def test_network_location_of_odd_input(values):
    assert values([None, "http://[::1/x", "http://a]b/x"], text.network_location) == [None, "", ""]


def test_network_location_of_random_urls(values):
    rng = random.Random(3)
    pieces = ["http", "https", ":", "/", "//", "a.b", "@", "?", "#", "x y", "80", "+", ".", "\t", "%20"]
    urls = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(3000)]
    assert values(urls, text.network_location) == [urlparse(u).netloc for u in urls]


def test_ip_flag(values):
    addresses = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "01.2.3.4", "a", "", None]
    expected = [True, True, None, None, None, None, None, None, None]
    assert values(addresses, text.ip_flag) == expected


def test_url_flag_accepts_what_the_plain_pattern_accepts(values):
    rng = random.Random(4)
    pieces = ["http://", "https://", "a", "b.c", ".", "/", "-", " ", "_", "co.uk", "?", ":80", "9", "Z", "é"]
    urls = ["".join(rng.choices(pieces, k=rng.randint(0, 8))) for _ in range(4000)]
    expected = [True if URL.search(u) else None for u in urls]
    assert values(urls, text.url_flag) == expected
    assert expected.count(True) > 100


def test_url_flag_does_not_backtrack(values):
    urls = ["http://" + "a.aa/" * 100_000 + "?", "a" * 500_000 + "?"]
    start = time.time()
    assert values(urls, text.url_flag) == [None, None]
    assert time.time() - start < 10
