"""Labelled URLs to train the URL filter on: which hosts are wanted in a text corpus and which aren't.

Label 0 is an ordinary site: press, schools, authorities, clubs, shops, documentation. Label 1 is a site whose pages are
there to sell or to deceive: gambling, pills, adult, quick money, fakes, warez, bait and phishing. The lists are common
knowledge about the public web and were written without looking at any table; from them URLs are put together by rule.
Both labels have hosts of one word and of several, with hyphens and without, the same schemes, most of the same
top-level names and paths; they differ in how often the rest occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Real sites that most people would call ordinary.
KNOWN = """
nytimes.com bbc.co.uk theguardian.com lemonde.fr elpais.com spiegel.de zeit.de lefigaro.fr elmundo.es reuters.com apnews.com npr.org
washingtonpost.com economist.com nature.com science.org plos.org arxiv.org wikipedia.org wiktionary.org archive.org gutenberg.org
britannica.com stanford.edu harvard.edu mit.edu berkeley.edu ox.ac.uk cam.ac.uk ethz.ch uni-heidelberg.de tu-berlin.de sorbonne-universite.fr
uam.es unesco.org who.int un.org europa.eu nasa.gov noaa.gov nih.gov cdc.gov usgs.gov loc.gov gov.uk bundestag.de service-public.fr
boe.es python.org rust-lang.org golang.org kernel.org debian.org apache.org postgresql.org mozilla.org gnu.org stackoverflow.com github.io
readthedocs.io w3.org ietf.org ieee.org acm.org springer.com elsevier.com jstor.org metmuseum.org louvre.fr museodelprado.es
nationalgeographic.com smithsonianmag.com weather.com allrecipes.com marmiton.org chefkoch.de ikea.com lego.com decathlon.fr
deutsche-bahn.com sncf.com renfe.com lufthansa.com airfrance.fr hiking-trails.org world-nuclear.org red-cross.org cancer.org
""".split()

#: Words that names of ordinary sites are made of.
ORDINARY = """
garden health history library river museum school city music kitchen travel science football weather village county valley
mountain harbor church bridge forest island college institute academy journal review gazette herald tribune observer
chronicle society foundation association council ministry hospital clinic dental family children teacher student learning research
physics biology chemistry math language grammar dictionary poetry novel theater cinema gallery photo painting design
architecture building carpenter furniture bakery coffee wine cheese recipe farming organic animal bird fishing cycling running
hiking sailing climbing yoga chess puzzle model railway train airport hotel camping map atlas world open north south east west
new old green blue red happy local national european american german french spanish data code software open source linux
""".split()

#: Words that names of unwanted sites are made of, by what they are after.
UNWANTED = """
casino poker jackpot slots betting roulette blackjack lottery bingo wager gamble odds spin vegas
viagra cialis pills pharmacy meds steroid weightloss diet slim tramadol xanax enlargement detox
porn xxx sex escort hookup webcam nude milf dating singles adult erotic fetish
payday loan forex crypto bitcoin profit millionaire cash earn invest income rich
replica rolex handbags outlet discount cheap knockoff wholesale
crack keygen torrent warez serial nulled cheats hacks download
free prize winner win giftcard click survey bonus reward claim offer deal hot best now today
login verify secure account update signin paypal wallet banking support alert confirm unlock
seo backlinks traffic popunder adserver tracker spam
""".split()

_COMMON_TOP = ("com", "com", "com", "com", "net", "org", "info", "de", "fr", "es", "co.uk")
_OTHER_TOP = (("edu", "gov", "ac.uk", "eu", "int", "museum"), ("xyz", "top", "click", "biz", "ru", "cn", "icu", "online", "tk"))
_SECTIONS = ("news", "blog", "articles", "docs", "en", "category", "pages", "post", "wiki", "forum", "shop", "about", "archive")
_LETTERS = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789"))


def labelled_urls(per_label: int = 4000, seed: int = 7, known: Sequence[str] = KNOWN, ordinary: Sequence[str] = ORDINARY, unwanted: Sequence[str] = UNWANTED) -> list[tuple[str, int]]:
    """(url, label), as many of either label, the same for the same arguments."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    some = lambda p: rng.random() < p
    token = lambda n: "".join(_LETTERS[rng.integers(0, 36, n)])

    def name(words) -> str:
        parts = [pick(words) for _ in range(int(rng.choice((1, 2, 3), p=(0.15, 0.6, 0.25))))]
        return ("-" if some(0.4) else "").join(dict.fromkeys(parts))

    def host(label: int) -> str:
        if not label:
            whole = pick(known) if some(0.25) else f"{name(ordinary)}{pick(('', '', '', '24', str(int(rng.integers(1900, 2025))))) if some(0.2) else ''}.{pick(_OTHER_TOP[0] if some(0.15) else _COMMON_TOP)}"
        else:
            kind = rng.random()
            stem = token(int(rng.integers(8, 20))) if kind < 0.12 else name(unwanted)
            if 0.12 <= kind < 0.3:
                mixed = pick(unwanted), pick(ordinary)
                stem = ("-" if some(0.4) else "").join(mixed if some(0.5) else mixed[::-1])
            if some(0.1):
                stem = stem.translate(str.maketrans("oile", "0113"))
            whole = f"{stem}{int(rng.integers(1, 999)) if some(0.25) else ''}.{pick(_OTHER_TOP[1] if some(0.3) else _COMMON_TOP)}"
        return pick(("www.", "m.", "blog.", "shop.", "en.")) + whole if some(0.45) else whole

    def path(label: int) -> str:
        if some(0.1 + 0.15 * label):
            return f"/{token(int(rng.integers(6, 24)))}" + ("" if some(0.5) else ".php")
        parts = [pick(_SECTIONS) for _ in range(int(rng.integers(0, 3)))] + ([f"{rng.integers(1998, 2025)}/{rng.integers(1, 13):02d}"] if some(0.2 - 0.1 * label) else [])
        slug = "-".join(pick(ordinary) for _ in range(int(rng.integers(1, 5)))) if some(0.4) else str(int(rng.integers(1, 100000))) if some(0.5) else ""
        return "/" + "/".join([*parts, *([slug] if slug else [])]) + (pick((".html", ".htm", ".php", "/")) if some(0.4) else "")

    def query(label: int) -> str:
        if not some(0.25 + 0.2 * label):
            return "#" + pick(_SECTIONS) if some(0.05) else ""
        names = ("id", "page", "q", "lang", "ref", "utm_source", "sort", "v") if some(0.75 - 0.45 * label) else ("aff", "clickid", "sub", "offer", "cid", "ref", "track", "sid", "token")
        return "?" + "&".join(f"{pick(names)}={token(int(rng.integers(4, 16))) if some(0.3 + 0.3 * label) else int(rng.integers(1, 500))}" for _ in range(int(rng.integers(1, 3 + 3 * label))))

    return [(f"{'https' if some(0.75 - 0.15 * label) else 'http'}://{host(label)}{path(label)}{query(label)}", label) for label in (0, 1) * per_label]
