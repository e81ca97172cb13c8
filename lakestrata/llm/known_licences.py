"""The known licences: full texts, standard notices, and the lines that name a licence."""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

#: Entire texts, one file each: the SPDX name, or ``name~source`` for another wording.
TEXTS = Path(__file__).with_name("licence_texts")


def _gnu(name: str, short: str, version: str) -> tuple[str, ...]:
    """The names of one version of a GNU licence; 3.0 is written 3 as well."""
    out = []
    for v in dict.fromkeys((version, version.removesuffix(".0"))):
        for stem in (f"GNU {name}", name, f"GNU {short}", short):
            for join in (" version ", " v", " "):
                out += [f"{stem}{join}{v}{more}" for more in ("", " only", " or later", " or any later version")]
        out += [f"{short}v{v}", f"{short}{v}"]
    return tuple(out)


def _creative_commons() -> dict[str, tuple[str, ...]]:
    out = {}
    parts = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    regions = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
    for (version, region), kind in product(regions.items(), ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")):
        said = "-".join(parts[p] for p in kind.split("-"))
        names = [f"CC {kind} {version}"]
        for words in dict.fromkeys((said, said.replace("ShareAlike", "Share Alike"), said.replace("NoDerivatives", "NoDerivs"))):
            names += [f"{stem}{words} {version}{end}" for stem in ("Creative Commons ", "CC ") for end in ("", f" {region}")]
        out[f"CC-{kind}-{version}"] = tuple(names)
    return out


#: What a notice calls each licence; "License" may follow.
NAMES: dict[str, tuple[str, ...]] = {
    "0BSD": ("0BSD", "BSD Zero Clause", "Zero-Clause BSD", "BSD 0-Clause"),
    "AGPL-3.0": _gnu("Affero General Public License", "AGPL", "3.0"),
    "Apache-2.0": ("Apache License Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0", "Apache 2", "Apache v2.0"),
    "Artistic-1.0-Perl": ("Artistic License 1.0 (Perl)",),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic 2.0"),
    "BlueOak-1.0.0": ("Blue Oak Model License 1.0.0", "Blue Oak Model License Version 1.0.0"),
    "BSD-2-Clause": ("BSD 2-Clause", "2-Clause BSD", "Simplified BSD", "FreeBSD", 'BSD 2-Clause "Simplified"'),
    "BSD-3-Clause": ("BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD", "Revised BSD", 'BSD 3-Clause "New" or "Revised"'),
    "BSL-1.0": ("Boost Software License", "Boost Software License 1.0", "Boost Software License Version 1.0", "Boost"),
    "CC0-1.0": ("CC0", "CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication", "Creative Commons Zero v1.0 Universal",
                "Creative Commons CC0 1.0 Universal", "Creative Commons Zero"),
    **_creative_commons(),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License Version 1.0", "EPL 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License Version 2.0", "EPL 2.0"),
    "GFDL-1.2": _gnu("Free Documentation License", "GFDL", "1.2"),
    "GFDL-1.3": _gnu("Free Documentation License", "GFDL", "1.3"),
    "GPL-1.0": _gnu("General Public License", "GPL", "1.0"),
    "GPL-2.0": _gnu("General Public License", "GPL", "2.0"),
    "GPL-3.0": _gnu("General Public License", "GPL", "3.0"),
    "ISC": ("ISC",),
    "LGPL-2.0": _gnu("Library General Public License", "LGPL", "2.0"),
    "LGPL-2.1": _gnu("Lesser General Public License", "LGPL", "2.1"),
    "LGPL-3.0": _gnu("Lesser General Public License", "LGPL", "3.0"),
    "MIT": ("MIT", "Expat", "MIT (Expat)", "MIT/X11", "MIT License (MIT)"),
    "MPL-1.1": ("Mozilla Public License 1.1", "Mozilla Public License Version 1.1", "Mozilla Public License v1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License v. 2.0",
                "Mozilla Public License v2.0", "MPL 2.0", "MPLv2"),
    "OFL-1.1": ("SIL Open Font License", "SIL Open Font License 1.1", "SIL Open Font License Version 1.1", "OFL 1.1"),
    "Unicode-3.0": ("Unicode License v3",),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "Zlib": ("zlib", "zlib/libpng"),
}


def _names(licence: str) -> list[str]:
    """What a notice may call the licence, with and without the word License at the end."""
    names = dict.fromkeys((licence, *NAMES[licence]))
    return list(dict.fromkeys(m for n in names for m in ((n, f"{n} License") if not re.search("Licen[cs]e", n) else (n,))))


def notices() -> list[tuple[str, str]]:
    """Lines that name a licence; canonical texts say ``licensed under`` for all words of that kind."""
    return [(licence, f"Licensed under {name}") for licence in NAMES for name in _names(licence)]


def _part(text: str, start: str, end: str) -> str:
    at = text.index(start)
    return text[at : text.index(end, at) + len(end)]


def _headers(texts: dict[str, str]) -> list[tuple[str, str]]:
    """The notices that the licences ask for at the head of a file: as a whole, and their first paragraph."""
    found = [
        ("Apache-2.0", _part(texts["Apache-2.0"], "Licensed under the Apache", "limitations under the License.")),
        ("MPL-2.0", _part(texts["MPL-2.0"], "This Source Code Form is subject", "http://mozilla.org/MPL/2.0/.")),
    ]
    shared, endings = "This program is free software", {}
    for licence in ("GPL-2.0", "GPL-3.0"):
        notice = texts[licence][texts[licence].rindex(shared) :]
        endings[licence] = notice[: notice.index("Also add information")]
    by_address = endings["GPL-2.0"].split("You should have received")[0]
    by_link = "You should have received" + endings["GPL-3.0"].split("You should have received")[1]
    found += [*endings.items(), ("GPL-2.0", by_address + by_link)]
    for licence, name in (("AGPL-3.0", "GNU Affero General"), ("LGPL-3.0", "GNU Lesser General")):
        found.append((licence, endings["GPL-3.0"].replace("GNU General", name)))
    more = []
    for licence, whole in found:
        parts = re.split(r"\n\s*\n", whole.strip())
        more += [(licence, whole), (licence, parts[0]), (licence, "\n".join(parts[:2]))]
    return more


def _wordings(licence: str, text: str) -> list[str]:
    """The text as it goes about: without its appendix, its list numbers or a name in it, with https, under its titles."""
    found = [text]
    for end in ("END OF TERMS AND CONDITIONS", "APPENDIX: How to apply", "How to Apply These Terms", "How to apply this License"):
        if end in text:
            before = text[: text.index(end)]
            found += [before, before + end] if end.startswith("END") else [before]
    if licence.startswith("BSD"):
        found += [t.replace("the copyright holder nor", f"{who} nor") for t in found for who in ("the University", "the author", "the project")]
        found += [re.sub(r"(?m)^\s*\d\.", " ", t) for t in found]
    if licence == "ISC":
        found += [t.replace("and/or distribute", "and distribute") for t in found]
    found += [t.replace("http://", "https://") for t in found] + [t.replace("https://", "http://") for t in found]
    titles = [""] + [f"{a}{n}{e}\n" for a, n, e in product(("", "The "), _names(licence), ("", f" ({licence})"))]
    untitled = len(text) < 2000
    return [title + t for t in dict.fromkeys(found) for title in (titles if untitled else titles[:1])]


def full_texts() -> list[tuple[str, str]]:
    """The entire texts in all their wordings, and the notices that stand at the head of files."""
    texts = {p.stem: p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    out = [(stem.split("~")[0], t) for stem, text in texts.items() for t in _wordings(stem.split("~")[0], text)]
    return out + _headers(texts)
