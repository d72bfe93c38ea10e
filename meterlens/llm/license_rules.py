"""Licence signatures of operator 11, stated plainly.

Every pattern is written over normalised text: words in lower case, one space
between them (so ``GPL-2.0+`` reads ``gpl 2 0``).  A pattern starts and ends
at a word's border and uses only what both Java's and RE2's dialects know.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """``number`` orders the rules, ``rank`` is the priority (0 is strongest)."""

    number: int
    rank: int
    label: str
    keyword: str  # a word that every match holds
    pattern: str
    strength: float
    base: bool


# Fixed phrases of the query's contract: phrase, label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Public licence names.  label | keyword | name pattern | SPDX identifier as words ("" if none).
SIGNATURES = r"""
gpl-1.0 | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)? (?:version|v) ?1 | gpl 1 0(?: only| or later)?
gpl-2.0 | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v ?)2(?: 0)? | gpl 2 0(?: only| or later)?
gpl-3.0 | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v ?)3(?: 0)? | gpl 3 0(?: only| or later)?
gpl-2.0 | gpl | gpl (?:version )?v?2(?: 0)? | gpl2
gpl-3.0 | gpl | gpl (?:version )?v?3(?: 0)? | gpl3
gpl-2.0 | gplv2 | gplv2(?: 0)? | gplv2
gpl-3.0 | gplv3 | gplv3(?: 0)? | gplv3
gpl | gnu | gnu gpl | gpl
gpl-classpath | classpath | (?:gnu general public licen[cs]e|gpl)(?: version)?(?: 2(?: 0)?)? with (?:the )?classpath exception | gpl 2 0 with classpath exception
gpl-linking | linking | (?:gnu general public licen[cs]e|gpl) with (?:a |the )?linking exception | gpl 2 0 with gcc exception
gpl-font | font | (?:gnu general public licen[cs]e|gpl) with (?:the )?font exception | gpl 2 0 with font exception
lgpl-2.0 | gnu | gnu library general public licen[cs]e(?: version| v)? ?2?(?: 0)? | lgpl 2 0(?: only| or later)?
lgpl-2.1 | gnu | gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v ?)2 1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | gnu | gnu lesser general public licen[cs]e(?: as published by the free software foundation)?(?: either)? (?:version |v ?)3(?: 0)? | lgpl 3 0(?: only| or later)?
lgpl | gnu | gnu lesser general public licen[cs]e | lgpl
lgpl | lgpl | (?:gnu )?lgpl(?: licen[cs]e)? | lgpl license
agpl-1.0 | affero | affero general public licen[cs]e (?:version |v ?)1(?: 0)? | agpl 1 0(?: only| or later)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e (?:version |v ?)3(?: 0)? | agpl 3 0(?: only| or later)?
agpl | affero | (?:gnu )?affero general public licen[cs]e | agpl
agpl | agpl | (?:gnu )?agpl(?: licen[cs]e)? | agpl license
gfdl-1.1 | documentation | gnu free documentation licen[cs]e (?:version |v ?)1 1 | gfdl 1 1(?: only| or later)?
gfdl-1.2 | documentation | gnu free documentation licen[cs]e (?:version |v ?)1 2 | gfdl 1 2(?: only| or later)?
gfdl-1.3 | documentation | gnu free documentation licen[cs]e (?:version |v ?)1 3 | gfdl 1 3(?: only| or later)?
gfdl | documentation | gnu free documentation licen[cs]e | gfdl
apache-1.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?1 0 | apache 1 0
apache-1.1 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?1 1 | apache 1 1
apache-2.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)? | apache 2 0
apache-2.0 | apache | (?:www )?apache org licenses license 2 0(?: txt| html)? | apache license 2 0
apache | apache | apache software licen[cs]e | apache
mit | mit | (?:the )?mit licen[cs]e | mit
mit-0 | mit | mit no attribution(?: licen[cs]e)? | mit 0
mit-x11 | x11 | (?:mit x11|x11 mit|x11) licen[cs]e | x11
mit-modern | mit | modern mit(?: variant)?(?: licen[cs]e)? | mit modern variant
mit | mit | opensource org licenses mit(?: license)?(?: php)? | mit license
expat | expat | expat licen[cs]e | expat
bsd-1-clause | bsd | (?:bsd 1 clause|1 clause bsd)(?: licen[cs]e)? | bsd 1 clause
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd bsd)(?: licen[cs]e)? | bsd 2 clause
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)? | bsd 3 clause
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)? | bsd 4 clause
bsd-0-clause | bsd | (?:zero|0) clause bsd(?: licen[cs]e)? | 0bsd
bsd-patent | bsd | bsd 2 clause plus patent(?: licen[cs]e)? | bsd 2 clause patent
bsd-clear | bsd | (?:clear bsd|bsd 3 clause clear)(?: licen[cs]e)? | bsd 3 clause clear
bsd | bsd | bsd(?: style)? licen[cs]e | bsd
freebsd | freebsd | freebsd(?: documentation)? licen[cs]e | freebsd doc
mpl-1.0 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 0 | mpl 1 0
mpl-1.1 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 1 | mpl 1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e (?:version |v ?)?2(?: 0)? | mpl 2 0
mpl | mozilla | mozilla public licen[cs]e | mpl
mpl-2.0 | mpl | mpl v?2(?: 0)? | mpl 2
npl-1.0 | netscape | netscape public licen[cs]e (?:version |v ?)?1 0 | npl 1 0
npl-1.1 | netscape | netscape public licen[cs]e (?:version |v ?)?1 1 | npl 1 1
npl | netscape | netscape public licen[cs]e | npl
epl-1.0 | eclipse | eclipse public licen[cs]e (?:version |v ?)?1 0 | epl 1 0
epl-2.0 | eclipse | eclipse public licen[cs]e (?:version |v ?)?2(?: 0)? | epl 2 0
epl | eclipse | eclipse public licen[cs]e | epl
edl-1.0 | eclipse | eclipse distribution licen[cs]e(?: (?:version |v ?)?1 0)? | edl 1 0
cpl-1.0 | common | common public licen[cs]e(?: (?:version |v ?)?1 0)? | cpl 1 0
ipl-1.0 | ibm | ibm public licen[cs]e(?: (?:version |v ?)?1 0)? | ipl 1 0
cddl-1.0 | distribution | common development and distribution licen[cs]e(?: cddl)? (?:version |v ?)?1 0 | cddl 1 0
cddl-1.1 | distribution | common development and distribution licen[cs]e(?: cddl)? (?:version |v ?)?1 1 | cddl 1 1
cddl | distribution | common development and distribution licen[cs]e | cddl
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)? | cc0 1 0
cc0-1.0 | creative | creative commons (?:zero|cc0)(?: 1 0)?(?: universal)? | cc0 1 0 universal
cc-pdm | public | public domain mark(?: 1 0)? | cc pdddc
cc-by-1.0 | cc | cc by 1 0 | cc by 1 0
cc-by-2.0 | cc | cc by 2 0 | cc by 2 0
cc-by-2.5 | cc | cc by 2 5 | cc by 2 5
cc-by-3.0 | cc | cc by 3 0 | cc by 3 0
cc-by-4.0 | cc | cc by 4 0 | cc by 4 0
cc-by-sa-3.0 | cc | cc by sa 3 0 | cc by sa 3 0
cc-by-sa-4.0 | cc | cc by sa 4 0 | cc by sa 4 0
cc-by-sa | cc | cc by sa | cc by sa
cc-by-nd-4.0 | cc | cc by nd 4 0 | cc by nd 4 0
cc-by-nd | cc | cc by nd | cc by nd
cc-by-nc-3.0 | cc | cc by nc 3 0 | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0 | cc by nc 4 0
cc-by-nc | cc | cc by nc | cc by nc
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0 | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0 | cc by nc sa 4 0
cc-by-nc-sa | cc | cc by nc sa | cc by nc sa
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0 | cc by nc nd 4 0
cc-by-nc-nd | cc | cc by nc nd | cc by nc nd
cc-by-3.0 | creative | creative commons attribution 3 0(?: unported| international)? | cc by 3
cc-by-4.0 | creative | creative commons attribution 4 0(?: international)? | cc by 4
cc-by | creative | creative commons attribution(?: licen[cs]e)? | cc by
cc-by-sa-3.0 | creative | creative commons attribution share ?alike 3 0(?: unported)? | cc by sa 3
cc-by-sa-4.0 | creative | creative commons attribution share ?alike 4 0(?: international)? | cc by sa 4
cc-by-sa | creative | creative commons attribution share ?alike | cc by sa any
cc-by-nd | creative | creative commons attribution no ?deriv(?:ative)?s | cc by nd any
cc-by-nc | creative | creative commons attribution non ?commercial | cc by nc any
cc-by-nc-sa | creative | creative commons attribution non ?commercial share ?alike | cc by nc sa any
cc-by-nc-nd | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s | cc by nc nd any
cc-by-4.0 | creativecommons | creativecommons org licenses by 4 0 | cc by 4 0 url
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4 0 | cc by sa 4 0 url
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4 0 | cc by nc 4 0 url
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0 | cc0 1 0 url
isc | isc | isc licen[cs]e | isc
zlib | zlib | zlib(?: libpng)? licen[cs]e | zlib
libpng | libpng | libpng licen[cs]e | libpng
bsl-1.0 | boost | boost software licen[cs]e(?: (?:version |v ?)?1 0)? | bsl 1 0
unlicense | unlicense | (?:the )?unlicense | unlicense
wtfpl | public | do what the f[a-z]+ you want to public licen[cs]e | wtfpl
artistic-1.0 | artistic | artistic licen[cs]e(?: (?:version |v ?)?1 0)? | artistic 1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version |v ?)?2(?: 0)? | artistic 2 0
perl | perl | same terms as perl(?: itself)? | artistic 1 0 perl
python-2.0 | python | python software foundation licen[cs]e(?: (?:version |v ?)?2(?: 0)?)? | python 2 0
psf | psf | psf licen[cs]e(?: agreement)? | psf 2 0
php-3.01 | php | php licen[cs]e (?:version |v ?)?3 01 | php 3 01
php | php | php licen[cs]e | php 3 0
ruby | ruby | ruby licen[cs]e | ruby
openssl | openssl | openssl licen[cs]e | openssl
openldap | openldap | openldap public licen[cs]e(?: (?:version |v ?)?2 8)? | oldap 2 8
postgresql | postgresql | postgresql licen[cs]e | postgresql
ofl-1.0 | font | sil open font licen[cs]e (?:version |v ?)?1 0 | ofl 1 0
ofl-1.1 | font | sil open font licen[cs]e(?: (?:version |v ?)?1 1)? | ofl 1 1
odbl-1.0 | database | open (?:data commons open )?database licen[cs]e(?: (?:version |v ?)?1 0)? | odbl 1 0
odc-by-1.0 | commons | open data commons attribution licen[cs]e(?: (?:version |v ?)?1 0)? | odc by 1 0
pddl-1.0 | commons | open data commons public domain dedication(?: and licen[cs]e)? | pddl 1 0
eupl-1.1 | european | european union public licen[cs]e (?:version |v ?)?1 1 | eupl 1 1
eupl-1.2 | european | european union public licen[cs]e(?: (?:version |v ?)?1 2)? | eupl 1 2
osl-3.0 | software | open software licen[cs]e(?: (?:version |v ?)?3 0)? | osl 3 0
afl-3.0 | academic | academic free licen[cs]e(?: (?:version |v ?)?3 0)? | afl 3 0
ecl-2.0 | educational | educational community licen[cs]e(?: (?:version |v ?)?2 0)? | ecl 2 0
ms-pl | microsoft | microsoft public licen[cs]e | ms pl
ms-rl | microsoft | microsoft reciprocal licen[cs]e | ms rl
apsl-2.0 | apple | apple public source licen[cs]e(?: (?:version |v ?)?2 0)? | apsl 2 0
qpl-1.0 | public | (?:the )?q public licen[cs]e(?: (?:version |v ?)?1 0)? | qpl 1 0
sspl-1.0 | server | server side public licen[cs]e(?: (?:version |v ?)?1(?: 0)?)? | sspl 1 0
busl-1.1 | business | business source licen[cs]e(?: (?:version |v ?)?1 1)? | busl 1 1
elastic-2.0 | elastic | elastic licen[cs]e(?: (?:version |v ?)?2 0)? | elastic 2 0
polyform-nc | polyform | polyform noncommercial licen[cs]e(?: 1 0 0)? | polyform noncommercial 1 0 0
vim | vim | vim licen[cs]e | vim
ntp | ntp | ntp licen[cs]e | ntp
ncsa | illinois | (?:university of )?illinois(?: ncsa)? open source licen[cs]e | ncsa
w3c | w3c | w3c software(?: notice and| and document)? licen[cs]e | w3c
unicode | unicode | unicode(?: data files and software)? licen[cs]e(?: agreement)? | unicode dfs 2016
cecill-2.1 | cecill | cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?: 2 1)? | cecill 2 1
mulan-psl-2.0 | mulan | mulan permissive software licen[cs]e(?: (?:version |v ?)?2)? | mulanpsl 2 0
hippocratic | hippocratic | hippocratic licen[cs]e | hippocratic 2 1
json | json | json licen[cs]e | json
curl | curl | curl licen[cs]e | curl
beerware | beerware | (?:the )?beerware licen[cs]e | beerware
proprietary | proprietary | proprietary and confidential | licenseref proprietary
openrail-m | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)? | licenseref openrail
"""

# Sentences of licence texts and notices.  label | keyword | pattern.
SENTENCES = r"""
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy
mit | noninfringement | merchantability fitness for a particular purpose and noninfringement
isc | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display
gpl | redistribute | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
lgpl | redistribute | you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e
agpl | redistribute | you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
gpl | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e
gpl | received | you should have received a copy of the gnu general public licen[cs]e
lgpl | received | you should have received a copy of the gnu lesser general public licen[cs]e
apache-2.0 | compliance | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | express | distributed on an as is basis without warranties or conditions of any kind either express or implied
mpl-2.0 | subject | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-1.1 | contents | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-1.0 | accompanying | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v ?1 0
epl-2.0 | accompanying | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v ?)?2 0
zlib | plainly | altered source versions must be plainly marked as such and must not be misrepresented
unlicense | unencumbered | this is free and unencumbered software released into the public domain
public-domain | public | (?:released|dedicated|placed|is) (?:in|into|to) the public domain
public-domain | domain | public domain dedication
cc0-1.0 | waived | has waived all copyright and related or neighboring rights
bsl-1.0 | organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
wtfpl | everyone | everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document and changing it is allowed
gpl | everyone | everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed
ofl-1.1 | reserved | with reserved font name
rights-reserved | reserved | all rights reserved
proprietary | confidential | (?:strictly )?confidential(?: and proprietary)? do not (?:copy|distribute|share)
proprietary | unauthorized | unauthorized (?:copying|use|distribution|reproduction)(?: of this file)?(?: via any medium)? is strictly prohibited
"""

#: What stands before a licence's name in a notice.
NOTICE = (r"(?:(?:dual |multi )?licen[cs]ed|released|distributed|available|published|provided|covered|governed|shared)"
          r" (?:under|by)(?: the)?(?: terms (?:of|and conditions of))?(?: the)? ")


def _lines(text: str) -> list[list[str]]:
    return [[f.strip() for f in line.split(" | ")] for line in text.strip().splitlines()]


def rules() -> list[Rule]:
    """All rules in order: identifiers, sentences, notices, names with a
    version, other names, base phrases."""
    found: dict[str, tuple[int, str, str, str, float, bool]] = {}

    def add(rank, label, keyword, pattern, strength, base=False):
        found.setdefault(pattern, (rank, label, keyword, pattern, strength, base))

    names = _lines(SIGNATURES)
    for phrase, label in BASE:
        add(4, label, phrase.split()[0], phrase, 0.6, True)
    for label, _, _, spdx in names:
        add(0, label, "spdx", "spdx license identifier " + spdx, 1.0)
    for label, keyword, pattern in _lines(SENTENCES):
        add(1, label, keyword, pattern, 0.95)
    for label, keyword, name, _ in names:
        versioned = any(c.isdigit() for c in label)
        add(2 if versioned else 3, label, keyword, NOTICE + name, 0.9)
        add(2 if versioned else 3, label, keyword, name, 0.8 if versioned else 0.7)
    ordered = sorted(found.values(), key=lambda r: r[0])
    return [Rule(i, *r) for i, r in enumerate(ordered)]
