"""Licence signatures, as regular expressions over normalised words.

The text they meet is lower case, its words parted by one space each, so
"BY-NC 4.0" reads "by nc 4 0". Every family lists its label, the words of its
identifier and the names it goes by; three signatures follow from each name
(an identifier tag, a grant "licensed under ...", and the bare name), and
further phrases of the licence texts are listed apart. Earlier kinds have
priority over later ones.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    priority: int  # smaller is stronger
    label: str
    keyword: str  # words that each text the pattern matches holds; they start at a word's start
    pattern: str
    weight: float  # how sure a detection is


_V = r"(?: (?:version|v))?"
_OR_LATER = r"(?: (?:or any later version|or later))?"

# label, identifier words, names: (keyword, pattern)
FAMILIES: tuple[tuple[str, str, tuple[tuple[str, str], ...]], ...] = (
    ("agpl-3.0", r"agpl 3 0(?: only| or later)?", (("affero", rf"(?:gnu )?affero general public license{_V}(?: 3(?: 0)?)?{_OR_LATER}"), ("agpl", r"agpl ?v?3"))),
    ("lgpl-2.1", r"lgpl 2 1(?: only| or later)?", (("lesser", rf"(?:gnu )?lesser general public license{_V} 2 1{_OR_LATER}"), ("lgpl", r"lgpl v?2 1"))),
    ("lgpl-3.0", r"lgpl 3 0(?: only| or later)?", (("lesser", rf"(?:gnu )?lesser general public license{_V} 3(?: 0)?{_OR_LATER}"), ("lgpl", r"lgpl ?v?3"))),
    ("lgpl-2.0", r"lgpl 2 0(?: only| or later)?", (("library general", rf"(?:gnu )?library general public license(?:{_V} 2(?: 0)?)?{_OR_LATER}"),)),
    ("gpl-2.0", r"gpl 2 0(?: only| or later)?", (("general public license", rf"(?:gnu )?general public license{_V} 2(?: 0)?{_OR_LATER}"), ("gpl", r"gpl ?v?2"))),
    ("gpl-3.0", r"gpl 3 0(?: only| or later)?", (("general public license", rf"(?:gnu )?general public license{_V} 3(?: 0)?{_OR_LATER}"), ("gpl", r"gpl ?v?3"))),
    ("gfdl-1.3", r"gfdl 1 3(?: only| or later)?", (("free documentation", rf"(?:gnu )?free documentation license(?:{_V} 1 [123])?{_OR_LATER}"),)),
    ("apache-2.0", r"apache 2 0", (("apache", rf"apache (?:software )?license{_V} 2(?: 0)?"), ("apache", r"apache 2 0 license"))),
    ("apache-1.1", r"apache 1 1", (("apache", rf"apache (?:software )?license{_V} 1 1"),)),
    ("apache-1.0", r"apache 1 0", (("apache", rf"apache (?:software )?license{_V} 1 0"),)),
    ("mit", r"mit", (("mit licen", r"mit licen[sc]e"), ("expat", r"expat licen[sc]e"))),
    ("mit-0", r"mit 0", (("mit no attribution", r"mit no attribution(?: license)?"),)),
    ("x11", r"x11", (("x11 license", r"x11 license"), ("x consortium", r"x consortium license"))),
    ("bsd-2-clause", r"bsd 2 clause", (("bsd", r"(?:bsd 2 clause|2 clause bsd)(?: license)?"), ("simplified bsd", r"simplified bsd license"))),
    ("bsd-3-clause", r"bsd 3 clause", (("bsd", r"(?:bsd 3 clause|3 clause bsd)(?: license)?"), ("bsd", r"(?:modified|revised|new) bsd license"))),
    ("bsd-4-clause", r"bsd 4 clause", (("bsd", r"(?:bsd 4 clause|4 clause bsd)(?: license)?"), ("original bsd", r"original bsd license"))),
    ("0bsd", r"0bsd", (("zero clause bsd", r"(?:bsd )?zero clause bsd(?: license)?"),)),
    ("isc", r"isc", (("isc license", r"isc license"), ("internet systems consortium", r"internet systems consortium license"))),
    ("mpl-2.0", r"mpl 2 0", (("mozilla", rf"mozilla public license{_V} 2(?: 0)?"), ("mpl", r"mpl v?2 0"))),
    ("mpl-1.1", r"mpl 1 1", (("mozilla", rf"mozilla public license{_V} 1 1"), ("mpl", r"mpl v?1 1"))),
    ("epl-1.0", r"epl 1 0", (("eclipse", rf"eclipse public license{_V} 1 0"),)),
    ("epl-2.0", r"epl 2 0", (("eclipse", rf"eclipse public license{_V} 2(?: 0)?"),)),
    ("cddl-1.0", r"cddl 1 0", (("common development", rf"common development and distribution license(?:{_V} 1 0)?"), ("cddl", r"cddl(?: 1 0)?"))),
    ("cpl-1.0", r"cpl 1 0", (("common public license", rf"common public license{_V} 1 0"),)),
    ("eupl-1.2", r"eupl 1 2", (("european union public", rf"european union public licen[sc]e(?:{_V} 1 [12])?"),)),
    ("artistic-2.0", r"artistic 2 0", (("artistic", r"artistic license 2 0"),)),
    ("artistic-1.0", r"artistic 1 0", (("artistic", r"artistic license(?: 1 0)?"),)),
    ("zlib", r"zlib", (("zlib", r"zlib(?: libpng)? license"),)),
    ("libpng", r"libpng", (("png reference library", r"png reference library license"), ("libpng", r"libpng license"))),
    ("bsl-1.0", r"bsl 1 0", (("boost", r"boost software license(?: version)?(?: 1 0)?"),)),
    ("busl-1.1", r"busl 1 1", (("business source", r"business source license(?: version)?(?: 1 1)?"),)),
    ("sspl-1.0", r"sspl 1 0", (("server side public", r"server side public license(?: version)?(?: 1(?: 0)?)?"),)),
    ("elastic-2.0", r"elastic 2 0", (("elastic license", r"elastic license(?: version)?(?: 2(?: 0)?)?"),)),
    ("unlicense", r"unlicense", (("unlicense", r"(?:the )?unlicense"),)),
    ("wtfpl", r"wtfpl", (("wtfpl", r"wtfpl"), ("what the f", r"do what the f\S* you want to public license"))),
    ("ms-pl", r"ms pl", (("microsoft public", r"microsoft public license"),)),
    ("ms-rl", r"ms rl", (("microsoft reciprocal", r"microsoft reciprocal license"),)),
    ("ofl-1.1", r"ofl 1 1", (("open font", r"(?:sil )?open font license(?: version)?(?: 1 1)?"),)),
    ("odbl-1.0", r"odbl 1 0", (("open database", r"open database license(?: version)?(?: 1 0)?"), ("open data commons", r"open data commons (?:open database|attribution) license"))),
    ("python-2.0", r"(?:python 2 0|psf 2 0)", (("python software foundation", r"python software foundation license(?: version 2)?"),)),
    ("php-3.01", r"php 3 01", (("php license", r"php license(?: version)?(?: 3 01)?"),)),
    ("postgresql", r"postgresql", (("postgresql", r"postgresql licen[sc]e"),)),
    ("ncsa", r"ncsa", (("ncsa", r"university of illinois ncsa open source license"),)),
    ("afl-3.0", r"afl 3 0", (("academic free", rf"academic free license(?:{_V} 3(?: 0)?)?"),)),
    ("osl-3.0", r"osl 3 0", (("open software license", rf"open software license(?:{_V} 3(?: 0)?)?"),)),
    ("cc0-1.0", r"cc0 1 0", (("cc0", r"cc0(?: 1 0)?(?: universal)?"), ("creative commons zero", r"creative commons zero(?: 1 0)?"))),
    ("cc-by-nc-nd", r"cc by nc nd \d 0", (("by nc nd", r"cc by nc nd(?: \d \d)?"), ("creative commons", r"creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: \d \d)?"))),
    ("cc-by-nc-sa", r"cc by nc sa \d 0", (("by nc sa", r"cc by nc sa(?: \d \d)?"), ("creative commons", r"creative commons attribution non ?commercial share ?alike(?: \d \d)?"))),
    ("cc-by-nc", r"cc by nc \d 0", (("by nc", r"cc by nc(?: \d \d)?"), ("creative commons", r"creative commons attribution non ?commercial(?: \d \d)?"))),
    ("cc-by-nd", r"cc by nd \d 0", (("by nd", r"cc by nd(?: \d \d)?"), ("creative commons", r"creative commons attribution no ?deriv(?:s|atives)(?: \d \d)?"))),
    ("cc-by-sa", r"cc by sa \d 0", (("by sa", r"cc by sa(?: \d \d)?"), ("creative commons", r"creative commons attribution share ?alike(?: \d \d)?"))),
    ("cc-by", r"cc by \d 0", (("cc by", r"cc by(?: \d \d)?"), ("creative commons", r"creative commons attribution(?: \d \d)?"))),
    ("gpl", r"gpl", (("general public license", r"(?:gnu )?general public license"), ("gnu gpl", r"gnu gpl"))),
    ("lgpl", r"lgpl", (("lesser general", r"(?:gnu )?lesser general public license"),)),
    ("apache", r"apache", (("apache", r"apache (?:software )?licen[sc]e"),)),
    ("bsd", r"bsd", (("bsd licen", r"bsd licen[sc]e"),)),
    ("mpl", r"mpl", (("mozilla public", r"mozilla public license"),)),
    ("epl", r"epl", (("eclipse public", r"eclipse public license"),)),
    ("creative-commons", r"creative commons", (("creative commons licen", r"creative commons licen[sc]e"),)),
)

# Phrases of the licences' own texts and notices: label, keyword, pattern.
PHRASES: tuple[tuple[str, str, str], ...] = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the software is provided", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit", "substantial portions", r"shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name", r"neither the name of \S+(?: \S+){0,12} may be used to endorse or promote"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "apache org licenses", r"apache org licenses license 2 0"),
    ("apache-2.0", "except in compliance", r"you may not use this file except in compliance with the license"),
    ("gpl", "free software foundation", r"under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "gnu org", r"gnu org (?:licenses|copyleft) gpl"),
    ("lgpl", "gnu org licenses", r"gnu org licenses lgpl"),
    ("agpl-3.0", "gnu org licenses", r"gnu org licenses agpl"),
    ("gfdl-1.3", "gnu org licenses", r"gnu org licenses fdl"),
    ("mpl-2.0", "mozilla org", r"mozilla org (?:en us )?mpl 2 0"),
    ("epl-2.0", "eclipse org", r"eclipse org legal epl (?:v )?2 0"),
    ("epl-1.0", "eclipse org", r"eclipse org legal epl v10"),
    ("bsl-1.0", "boost org", r"boost org license 1 0 txt"),
    ("mit", "opensource org", r"opensource org licenses? mit(?: license)?"),
    ("bsd-3-clause", "opensource org", r"opensource org licenses? bsd 3 clause"),
    ("bsd-2-clause", "opensource org", r"opensource org licenses? bsd 2 clause"),
    ("unlicense", "unlicense org", r"unlicense org"),
    ("unlicense", "free and unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "creativecommons org", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org", r"creativecommons org licenses by \d \d"),
    ("cc-by-sa", "creativecommons org", r"creativecommons org licenses by sa \d \d"),
    ("cc-by-nc", "creativecommons org", r"creativecommons org licenses by nc \d \d"),
    ("cc-by-nd", "creativecommons org", r"creativecommons org licenses by nd \d \d"),
    ("cc-by-nc-sa", "creativecommons org", r"creativecommons org licenses by nc sa \d \d"),
    ("cc-by-nc-nd", "creativecommons org", r"creativecommons org licenses by nc nd \d \d"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("ofl-1.1", "scripts sil org", r"scripts sil org ofl"),
    ("reserved", "all rights reserved", r"all rights reserved"),
    ("reserved", "rights reserved", r"(?:some|no) rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this (?:file|software|work)"),
    ("proprietary", "prior written", r"without (?:the )?prior written (?:permission|consent)"),
    ("copyright", "copyright", r"copyright (?:c )?(?:by )?\d{4}"),
    ("copyright", "copyrighted", r"this (?:work|document|material) is copyrighted"),
)

_GRANT = r"(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?"


def rules() -> tuple[Rule, ...]:
    """All signatures in order of priority."""
    found: list[Rule] = []
    for label, words, _ in FAMILIES:
        found.append(Rule(1, label, "spdx license identifier", rf"spdx license identifier {words}", 1.0))
    for label, _, names in FAMILIES:
        found += [Rule(2, label, keyword, _GRANT + f"(?:{name})", 0.95) for keyword, name in names]
    found += [Rule(3, label, keyword, pattern, 0.9) for label, keyword, pattern in PHRASES]
    for label, _, names in FAMILIES:
        found += [Rule(4, label, keyword, name, 0.8) for keyword, name in names]
    return tuple(found)
