"""Ordered signature rules of license texts, over words in lower case.

A signature is a regular expression over words that single spaces part; the
word in angle brackets is its keyword, which stands in it as it is written.
Optional words carry their space with them. No signature reaches over more than
``REACH`` words on either side of its keyword, so a place is judged by its
neighbourhood alone.
"""

from __future__ import annotations

from typing import NamedTuple

#: Words that are looked at on either side of a keyword.
REACH = 14


class Rule(NamedTuple):
    """``rank``: the order of the rule; ``strength``: 4 for a machine-readable mark, 3 for a name with its version or an address, 2 for a name, 1 for words that only hint."""

    rank: int
    strength: int
    label: str
    keyword: str
    before: str
    after: str
    base: bool


#: Phrases whose every place counts, and their labels.
BASE = (("<gnu> general public license", "gpl"), ("<apache> license", "apache"), ("<cc> by", "cc-by"), ("mit <license>", "mit"))

_V = "( version| v| ver)? v?"

#: label; names with their strength; words of the identifier after "SPDX-License-Identifier".
_LICENSES = f"""
gpl-1.0; 3 <gnu> general public license{_V}1( 0)?, 3 <gpl>{_V}1 0; gpl 1 0( only| or later)?
gpl-2.0-only; 3 <gnu> general public license{_V}2( 0)?( only)?, 3 <gpl>{_V}2( 0)?( only)?, 3 <gplv2>, 3 <gnu> org licenses( old licenses)? gpl 2 0; gpl 2 0( only)?
gpl-2.0-or-later; 3 <gnu> general public license{_V}2( 0)?( of the license)? or( at your option)? any later( version)?, 3 either version 2 of the <license> or at your option any later version, 3 <gpl>{_V}2( 0)? or( any)? later, 3 <gplv2> or later; gpl 2 0 or later
gpl-3.0-only; 3 <gnu> general public license{_V}3( 0)?( only)?, 3 <gpl>{_V}3( 0)?( only)?, 3 <gplv3>, 3 <gnu> org licenses gpl 3 0; gpl 3 0( only)?
gpl-3.0-or-later; 3 <gnu> general public license{_V}3( 0)?( of the license)? or( at your option)? any later( version)?, 3 either version 3 of the <license> or at your option any later version, 3 <gpl>{_V}3( 0)? or( any)? later, 3 <gplv3> or later; gpl 3 0 or later
gpl; 2 <gnu> gpl, 2 <gpl>, 2 general public <license>( gpl)?; gpl
lgpl-2.0; 3 <gnu> (library|lesser) general public license{_V}2( 0)?, 3 <lgpl>{_V}2 0; lgpl 2 0( only| or later)?
lgpl-2.1; 3 <gnu> lesser general public license{_V}2 1( or( at your option)? any later version)?, 3 <lgpl>{_V}2 1, 3 <gnu> org licenses( old licenses)? lgpl 2 1; lgpl 2 1( only| or later)?
lgpl-3.0; 3 <gnu> lesser general public license{_V}3( 0)?( or( at your option)? any later version)?, 3 <lgpl>{_V}3( 0)?, 3 <lgplv3>, 3 <gnu> org licenses lgpl 3 0; lgpl 3 0( only| or later)?
lgpl; 2 <gnu> (library|lesser) general public license, 2 (library|lesser) general <public> license, 2 <lgpl>; lgpl
agpl-3.0; 3 <gnu> affero general public license{_V}3( 0)?( or( at your option)? any later version)?, 3 <agpl>{_V}3( 0)?, 3 <agplv3>, 3 <gnu> org licenses agpl 3 0; agpl 3 0( only| or later)?
agpl; 2 <gnu> affero general public license, 2 <affero> general public license, 2 <agpl>; agpl
gfdl; 3 <gnu> free documentation license{_V}1 [123], 2 <gnu> free documentation license, 2 <gfdl>; gfdl 1 [123]( only| or later)?
gpl-2.0-classpath-exception; 3 <gpl>{_V}2( 0)? with( the)? classpath exception, 3 <classpath> exception to the gpl; gpl 2 0 with classpath exception( 2 0)?
apache-1.0; 3 <apache>( software)? license{_V}1 0; apache 1 0
apache-1.1; 3 <apache>( software)? license{_V}1 1; apache 1 1
apache-2.0; 3 <apache>( software)? license{_V}2( 0)?, 3 <apache> 2( 0)?( license)?, 3 <apache> org licenses license 2 0, 3 <asl> 2 0, 3 <alv2>; apache 2 0
apache; 2 <apache> software license, 2 licensed to the <apache> software foundation asf under one or more contributor license agreements; apache
mit; 2 the mit <license>( mit)?, 2 mit <licensed>, 3 <opensource> org licenses mit( license)?, 2 the expat <license>, 3 permission is <hereby> granted free of charge to any person obtaining a copy of this software; mit
mit-0; 3 mit no <attribution>( license)?; mit 0
x11; 3 the x11 <license>, 2 x11 <license>, 2 mit x11 <license>; x11
isc; 3 the isc <license>, 2 isc <license>, 3 permission to use copy modify and or <distribute> this software for any purpose with or without fee; isc
0bsd; 3 zero clause <bsd>( license)?, 3 <0bsd>; 0bsd
bsd-2-clause; 3 (2|two) clause <bsd>( license)?, 3 <bsd> (2|two) clause( license)?, 3 simplified <bsd>( license)?, 3 <freebsd> license, 3 <opensource> org licenses bsd 2 clause; bsd 2 clause
bsd-3-clause; 3 (3|three) clause <bsd>( license)?, 3 <bsd> (3|three) clause( license)?, 3 (new|modified|revised) <bsd>( license)?, 3 <opensource> org licenses bsd 3 clause, 3 neither the name of( the)? [^ ]+( [^ ]+)? nor the names of its <contributors> may be used to endorse; bsd 3 clause
bsd-4-clause; 3 (4|four) clause <bsd>( license)?, 3 original <bsd>( license)?, 3 all <advertising> materials mentioning features or use of this software; bsd 4 clause
bsd; 2 <bsd>( style)? license(s)?, 2 <bsd> licensed, 2 <redistribution> and use in source and binary forms with or without modification; bsd
mpl-1.0; 3 <mozilla> public license{_V}1 0, 3 <mpl>{_V}1 0; mpl 1 0
mpl-1.1; 3 <mozilla> public license{_V}1 1, 3 <mpl>{_V}1 1; mpl 1 1
mpl-2.0; 3 <mozilla> public license{_V}2( 0)?, 3 <mpl>{_V}2( 0)?, 3 <mozilla> org mpl 2 0, 3 subject to the terms of the <mozilla> public license v 2 0; mpl 2 0
mpl; 2 <mozilla> public license, 2 <mpl>; mpl
epl-1.0; 3 <eclipse> public license{_V}1( 0)?, 3 <epl>{_V}1( 0)?; epl 1 0
epl-2.0; 3 <eclipse> public license{_V}2( 0)?, 3 <epl>{_V}2( 0)?, 3 <eclipse> org legal epl 2 0; epl 2 0
epl; 2 <eclipse> public license; epl
edl-1.0; 3 <eclipse> distribution license( version| v)? 1 0, 2 <eclipse> distribution license; edl 1 0
cddl-1.0; 3 common development and distribution <license>{_V}1 0, 3 <cddl>{_V}1 0; cddl 1 0
cddl-1.1; 3 common development and distribution <license>{_V}1 1, 3 <cddl>{_V}1 1; cddl 1 1
cddl; 2 common development and distribution <license>, 2 <cddl>; cddl
cpl-1.0; 3 common public <license>{_V}1 0, 2 common public <license>; cpl 1 0
eupl-1.1; 3 <european> union public (license|licence){_V}1 1, 3 <eupl>{_V}1 1; eupl 1 1
eupl-1.2; 3 <european> union public (license|licence){_V}1 2, 3 <eupl>{_V}1 2; eupl 1 2
eupl; 2 <european> union public (license|licence), 2 <eupl>; eupl
artistic-1.0; 3 <artistic> license{_V}1( 0)?; artistic 1 0( perl| cl8)?
artistic-2.0; 3 <artistic> license{_V}2( 0)?, 3 <perlfoundation> org artistic license 2 0; artistic 2 0
artistic; 2 the <artistic> license, 2 same terms as <perl> itself; artistic
bsl-1.0; 3 <boost> software license{_V}1 0, 2 <boost> software license, 3 <boost> org license 1 0; bsl 1 0
busl-1.1; 3 business source <license>{_V}1 1, 2 business source <license>; busl 1 1
sspl-1.0; 3 server side public <license>{_V}1( 0)?, 2 server side public <license>, 2 <sspl>; sspl 1 0
elastic-2.0; 3 <elastic> license{_V}2( 0)?, 2 <elastic> license; elastic 2 0
commons-clause; 3 <commons> clause license condition( v)? 1 0, 2 <commons> clause; commons clause
polyform; 3 <polyform> (noncommercial|shield|strict|perimeter|small business) license( 1 0 0)?; polyform (noncommercial|small business) 1 0 0
unlicense; 3 the <unlicense>, 3 <unlicense> org, 3 this is free and unencumbered software released into the public <domain>; unlicense
wtfpl; 3 do what the f[^ ]* you want to public <license>, 3 <wtfpl>; wtfpl
zlib; 3 zlib <license>, 3 zlib libpng <license>, 2 this software is provided as is without any express or implied <warranty> in no event will the authors be held liable; zlib
libpng; 3 libpng <license>, 3 png reference library <license>; libpng( 2 0)?
postgresql; 3 <postgresql> license; postgresql
python-2.0; 3 <python> software foundation license{_V}2, 2 <python> software foundation license, 2 <psf> license( agreement)?; (python|psf) 2 0
php-3.01; 3 <php> license{_V}3 01, 2 <php> license; php 3 01
ruby; 3 <ruby> license, 2 same terms as <ruby>; ruby
openssl; 3 <openssl> license, 2 <openssl> and ssleay licenses; openssl
ncsa; 3 university of illinois <ncsa> open source license, 3 <ncsa> license; ncsa
ms-pl; 3 <microsoft> public license( ms pl)?, 2 ms pl <license>; ms pl
ms-rl; 3 <microsoft> reciprocal license( ms rl)?; ms rl
upl-1.0; 3 universal <permissive> license{_V}1 0, 2 universal <permissive> license; upl 1 0
afl-3.0; 3 <academic> free license{_V}3 0, 2 <academic> free license; afl [123] [01]
osl-3.0; 3 open software <license>{_V}3 0, 2 open software <license>; osl [123] 0
ecl-2.0; 3 <educational> community license{_V}2 0, 2 <educational> community license; ecl 2 0
ofl-1.1; 3 sil open <font> license{_V}1 1, 2 sil open <font> license, 3 <scripts> sil org ofl, 2 open <font> license; ofl 1 1
ijg; 2 independent <jpeg> group license; ijg
unicode; 3 <unicode> license( agreement)?( v3)?, 3 <unicode> org copyright html; unicode (3 0|dfs 201[56])
w3c; 3 <w3c> software( and document)?( notice and)? license, 2 <w3c> license; w3c
odbl-1.0; 3 open database <license>{_V}1 0, 2 open database <license>, 3 <opendatacommons> org licenses odbl( 1 0)?, 2 <odbl>; odbl 1 0
odc-by-1.0; 3 open data <commons> attribution license( v1 0)?, 3 <opendatacommons> org licenses by( 1 0)?; odc by 1 0
pddl-1.0; 3 public <domain> dedication and license, 3 <opendatacommons> org licenses pddl( 1 0)?; pddl 1 0
cc0-1.0; 3 <cc0>( 1 0)?( universal)?, 3 <creativecommons> org publicdomain zero 1 0, 3 <creative> commons zero( v 1 0)?; cc0 1 0
cc-pdm; 3 <creativecommons> org publicdomain mark 1 0, 2 public <domain> mark( 1 0)?; cc pdm
cc-by-1.0; 3 <cc> by 1 0, 3 <creativecommons> org licenses by 1 0, 3 <creative> commons attribution 1 0; cc by 1 0
cc-by-2.0; 3 <cc> by 2 0, 3 <creativecommons> org licenses by 2 0, 3 <creative> commons attribution 2 0; cc by 2 0
cc-by-2.5; 3 <cc> by 2 5, 3 <creativecommons> org licenses by 2 5, 3 <creative> commons attribution 2 5; cc by 2 5
cc-by-3.0; 3 <cc> by 3 0, 3 <creativecommons> org licenses by 3 0, 3 <creative> commons attribution 3 0; cc by 3 0
cc-by-4.0; 3 <cc> by 4 0, 3 <creativecommons> org licenses by 4 0, 3 <creative> commons attribution 4 0( international)?; cc by 4 0
cc-by; 2 <creative> commons attribution( license)?, 2 <creativecommons> org licenses by; cc by
cc-by-sa-3.0; 3 <cc> by sa 3 0, 3 <creativecommons> org licenses by sa 3 0, 3 <creative> commons attribution share ?alike 3 0; cc by sa 3 0
cc-by-sa-4.0; 3 <cc> by sa 4 0, 3 <creativecommons> org licenses by sa 4 0, 3 <creative> commons attribution share ?alike 4 0( international)?; cc by sa 4 0
cc-by-sa; 2 <cc> by sa, 2 <creative> commons attribution share ?alike( license)?, 2 <creativecommons> org licenses by sa; cc by sa
cc-by-nc-3.0; 3 <cc> by nc 3 0, 3 <creativecommons> org licenses by nc 3 0, 3 <creative> commons attribution non ?commercial 3 0; cc by nc 3 0
cc-by-nc-4.0; 3 <cc> by nc 4 0, 3 <creativecommons> org licenses by nc 4 0, 3 <creative> commons attribution non ?commercial 4 0( international)?; cc by nc 4 0
cc-by-nc; 2 <cc> by nc, 2 <creative> commons attribution non ?commercial( license)?, 2 <creativecommons> org licenses by nc; cc by nc
cc-by-nc-sa; 3 <cc> by nc sa( [1-4] [05])?, 3 <creativecommons> org licenses by nc sa( [1-4] [05])?, 3 <creative> commons attribution non ?commercial share ?alike( [1-4] [05])?( international)?; cc by nc sa [1-4] [05]
cc-by-nc-nd; 3 <cc> by nc nd( [1-4] [05])?, 3 <creativecommons> org licenses by nc nd( [1-4] [05])?, 3 <creative> commons attribution non ?commercial no ?deriv(ative)?s( [1-4] [05])?( international)?; cc by nc nd [1-4] [05]
cc-by-nd; 3 <cc> by nd( [1-4] [05])?, 3 <creativecommons> org licenses by nd( [1-4] [05])?, 3 <creative> commons attribution no ?deriv(ative)?s( [1-4] [05])?( international)?; cc by nd [1-4] [05]
cc; 1 <creative> commons( public)? license, 1 <creative> commons, 1 <creativecommons> org; cc
public-domain; 2 (in|into|to) the public <domain>, 2 public <domain> dedication, 1 public <domain>; public domain
llama; 3 <llama> [234]( [0-9])? community license( agreement)?, 2 meta <llama> license; llama [234]( [0-9])?
openrail; 3 <bigscience> rail license, 3 creativeml open <rail> m, 2 <openrail>( m)?; openrail( m)?
proprietary; 2 all rights <reserved>, 2 <proprietary> and confidential, 2 confidential and <proprietary>, 2 <unauthorized> (copying|reproduction|distribution) of this (file|work|software|document) is (strictly )?prohibited; proprietary
copyright; 1 <copyright>( c)? (19|20)[0-9][0-9], 1 <copyright> holders?, 1 <copyright> notice; copyright
unknown; 1 <licensed> under( the terms of)?( the| a| an)?( [^ ]+)* license, 1 (distributed|released|published|available) under( the terms of)?( the| a| an)? [^ ]+ <license>, 1 see( the)? <license>( file)? for( the full)?( license| copyright)?( terms| text| details| information), 1 <licence> (agreement|terms), 1 <license> (agreement|terms|conditions), 1 <licensed> under, 1 terms of( the| this)? <license>, 1 <sublicense>; unknown
"""


def _split(signature: str) -> tuple[str, str, str]:
    before, keyword, after = signature.replace("<", ">").split(">")
    return keyword, before, after


def _rules() -> list[Rule]:
    signatures: list[tuple[int, str, str, bool]] = [(2, label, s, True) for s, label in BASE]
    for line in _LICENSES.strip().splitlines():
        label, names, mark = (x.strip() for x in line.split(";"))
        for name in names.split(", "):
            strength, signature = name.strip().split(" ", 1)
            signatures.append((int(strength), label, signature.replace("( [^ ]+)*", "( [^ ]+)?( [^ ]+)?( [^ ]+)?( [^ ]+)?"), False))
        signatures += [(4, label, f"<spdx> license identifier {mark}", False), (3, label, f"<spdx> org licenses {mark}", False)]
    return [Rule(k, strength, label, *_split(s), base) for k, (strength, label, s, base) in enumerate(signatures)]


RULES = _rules()
KEYWORDS = sorted({r.keyword for r in RULES})
