"""Signatures of public licenses, written by hand: sentences of their texts, notices, titles and SPDX expressions.

A line is ``label | keyword | pattern``. Both are in the words of a text: lower
case, one blank for everything between words. Every match of the pattern
contains the keyword; where a pattern is left out, the keyword is the pattern.
"""

from __future__ import annotations

# Wording of the license texts. Sentences that only one license has.
TEXTS = """
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | the above copyright notice and this permission notice shall be included in all copies
mit | to deal in the software without restriction | to deal in the software without restriction including without limitation the rights to use copy modify
mit-0 | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 | except as contained in this notice the name | except as contained in this notice the names? of (?:the x consortium|the copyright holders?|the above copyright holders?|[a-z]+) shall not be used in advertising
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
0bsd | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
hpnd | permission to use copy modify and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification
bsd-2-clause | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided
bsd-3-clause | may be used to endorse or promote products | neither the names? of (?:the )?(?:[a-z0-9]+ ){1,12}?(?:nor|or) the names of (?:its|their|the|other) contributors may be used to endorse or promote products
bsd-3-clause | may not be used to endorse or promote products | the names? of (?:the )?(?:[a-z0-9]+ ){1,12}?may not be used to endorse or promote products derived from this software
bsd-4-clause | all advertising materials mentioning features | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-1.1 | the end user documentation included with the redistribution | the end user documentation included with the redistribution if any must include the following acknowledge?ment
apache-2 | each contributor hereby grants to you a perpetual worldwide | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent)
apache-2 | terms and conditions for use reproduction and distribution
apache-2 | you may not use this file except in compliance with the license
apache-2 | apache org licenses license 2 0
gpl-2 | gnu general public license version 2 june 1991
gpl-2 | you may copy and distribute verbatim copies of the program s source code as you receive it
gpl-3 | gnu general public license version 3 29 june 2007
gpl-3 | the gnu general public license is a free copyleft license for software and other kinds of works
gpl | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2 | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2
gpl-3 | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3
gpl | the licenses for most software are designed to take away your freedom
gpl | you should have received a copy of the gnu general public license
lgpl | this library is free software | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | you should have received a copy of the gnu lesser general public license
lgpl-2 | gnu library general public license version 2 june 1991
lgpl-2.1 | gnu lesser general public license version 2 1 february 1999
lgpl-2.1 | the first released version of the lesser gpl it also counts as the successor of the gnu library public license
lgpl-3 | gnu lesser general public license version 3 29 june 2007
lgpl-3 | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
agpl-3 | gnu affero general public license version 3 19 november 2007
agpl-3 | the gnu affero general public license is a free copyleft license
agpl | you should have received a copy of the gnu affero general public license
agpl-3 | remote network interaction use with the gnu general public license
fdl-1.3 | gnu free documentation license version 1 3
fdl-1.2 | gnu free documentation license version 1 2
fdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
mpl-2 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2 | if a copy of the mpl was not distributed with this file you can obtain one
mpl-2 | mozilla public license | mozilla public license (?:version|v) 2(?: 0)?
epl-1 | eclipse public license | eclipse public license (?:version|v) 1(?: 0)?
epl-2 | eclipse public license | eclipse public license (?:version|v) 2(?: 0)?
epl | the accompanying program is provided under the terms of this eclipse public license
cpl-1 | common public license | common public license (?:version|v) 1(?: 0)?
ipl-1 | ibm public license | ibm public license (?:version|v) 1(?: 0)?
cddl-1 | common development and distribution license | common development and distribution license(?: cddl)?(?: version)? 1 [01]
eupl-1.1 | european union public licence | european union public licence (?:eupl )?(?:version|v) ?1 1
eupl-1.2 | european union public licence | european union public licence (?:eupl )?(?:version|v) ?1 2
zlib | in no event will the authors be held liable for any damages arising from the use of this software
zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | this notice may not be removed or altered from any source distribution
libpng | the png reference library is supplied as is
boost-1 | boost software license version 1 0
boost-1 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
artistic-1 | the intent of this document is to state the conditions under which a package may be copied
artistic-2 | this license establishes the terms under which a given free software package may be copied modified distributed
perl | you can redistribute it and or modify it under the same terms as perl itself | -
python-2 | python software foundation license version 2
python-2 | this license agreement is between the python software foundation psf
unlicense | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | do what the fuck you want to public license
wtfpl | you just do what the fuck you want to
beerware | the beer ware license | the beer ware license(?: revision 42)?
beerware | you can buy me a beer in return
cc0-1 | the person who associated a work with this deed has dedicated the work to the public domain
cc0-1 | creative commons cc0 1 0 universal | -
cc0-1 | to the extent possible under law | to the extent possible under law (?:the )?(?:[a-z0-9]+ ){1,10}?ha(?:s|ve) waived all copyright and related
public-domain | dedicated to the public domain
public-domain | released into the public domain
public-domain | placed in the public domain
public-domain | is in the public domain | this (?:file|code|software|work) is in the public domain
ofl-1.1 | sil open font license version 1 1
ofl-1.1 | permission is hereby granted free of charge to any person obtaining a copy of the font software
openssl | this product includes software developed by the openssl project
ssleay | this product includes cryptographic software written by eric young
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ncsa | neither the names of | neither the names of (?:[a-z0-9]+ ){1,14}?nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission the software is provided
ncsa | university of illinois ncsa open source license
ms-pl | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
json | the software shall be used for good not evil
curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
w3c | this work is being provided by the copyright holders under the following license
unicode | unicode data files include all data files under the directories
vim | vim is charityware you can use and copy it as much as you like
php-3 | the php license version 3 | the php license version 3 (?:0|01)
ruby | ruby is copyrighted free software by yukihiro matsumoto
afl-3 | academic free license | academic free license (?:version|v) ?3 0
osl-3 | open software license | open software license (?:version|v) ?3 0
ecl-2 | educational community license | educational community license (?:version|v) ?2 0
qpl-1 | the q public license | the q public license (?:version|v) ?1 0
odbl-1 | open data commons open database license | -
odc-by-1 | open data commons attribution license | -
pddl-1 | open data commons public domain dedication and license | -
sspl-1 | server side public license | server side public license(?: sspl)?(?: version| v)? ?1?
elastic-2 | elastic license 2 0 | -
busl-1.1 | business source license 1 1 | -
upl-1 | universal permissive license | the universal permissive license (?:upl )?(?:version|v) ?1 0
bsl-1.1 | change license means a license | -
blueoak-1 | blue oak model license | -
mulan-2 | mulan permissive software license | mulan permissive software license(?: mulan ?psl)? ?(?:version|v) ?2
cecill-2.1 | cecill free software license agreement | -
proprietary | this software is the confidential and proprietary information of
proprietary | unauthorized copying of this file via any medium is strictly prohibited
"""

# Names of licenses in full, as titles or in sentences.
TITLES = """
mit | the mit license | the mit license(?: mit)?
mit | expat license | -
bsd-2-clause | the 2 clause bsd license | -
bsd-2-clause | simplified bsd license | -
bsd-3-clause | the 3 clause bsd license | -
bsd-3-clause | revised bsd license | -
bsd-4-clause | original bsd license | -
isc | the isc license | -
apache-2 | apache license version 2 0 | apache license version 2 0(?: january 2004)?
apache-2 | apache software license 2 0 | -
gpl-2 | gnu general public license | gnu general public license (?:gpl )?(?:version|v) ?2(?: 0)?
gpl-3 | gnu general public license | gnu general public license (?:gpl )?(?:version|v) ?3(?: 0)?
lgpl-2.1 | gnu lesser general public license | gnu lesser general public license (?:lgpl )?(?:version|v) ?2 1
lgpl-3 | gnu lesser general public license | gnu lesser general public license (?:lgpl )?(?:version|v) ?3(?: 0)?
agpl-3 | gnu affero general public license | gnu affero general public license (?:agpl )?(?:version|v) ?3(?: 0)?
cc-by | creative commons attribution | creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: public)? licen[sc]e
cc-by-sa | creative commons attribution share | creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nd | creative commons attribution no | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nc | creative commons attribution non | creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: public)? licen[sc]e
cc-by-nc-sa | creative commons attribution non | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nc-nd | creative commons attribution non | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by | creativecommons org licenses by | creativecommons org licenses by [1-4] [05]
cc-by-sa | creativecommons org licenses by sa | creativecommons org licenses by sa [1-4] [05]
cc-by-nd | creativecommons org licenses by nd | creativecommons org licenses by nd [1-4] [05]
cc-by-nc | creativecommons org licenses by nc | creativecommons org licenses by nc [1-4] [05]
cc-by-nc-sa | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd [1-4] [05]
cc0-1 | creativecommons org publicdomain zero 1 0 | -
mit | opensource org licenses mit | opensource org licenses mit(?: license)?
bsd-2-clause | opensource org licenses bsd 2 clause | -
bsd-3-clause | opensource org licenses bsd 3 clause | -
gpl-2 | gnu org licenses | gnu org licenses (?:old licenses )?gpl 2(?: 0)?
gpl-3 | gnu org licenses gpl 3 | gnu org licenses gpl 3(?: 0)?
"""

# SPDX identifiers in words, and the label of each.
SPDX = """
mit-0 | mit 0
mit | mit(?! 0 )
apache-2 | apache 2 0
apache-1.1 | apache 1 1
bsd-2-clause | bsd 2 clause
bsd-3-clause | bsd 3 clause
bsd-4-clause | bsd 4 clause
0bsd | 0bsd
isc | isc
gpl-2 | gpl 2 0(?: only| or later)?
gpl-3 | gpl 3 0(?: only| or later)?
lgpl-2.1 | lgpl 2 1(?: only| or later)?
lgpl-3 | lgpl 3 0(?: only| or later)?
agpl-3 | agpl 3 0(?: only| or later)?
mpl-2 | mpl 2 0
epl-1 | epl 1 0
epl-2 | epl 2 0
cddl-1 | cddl 1 [01]
eupl-1.2 | eupl 1 2
zlib | zlib
boost-1 | bsl 1 0
unlicense | unlicense
cc0-1 | cc0 1 0
cc-by | cc by [1-4] 0
cc-by-sa | cc by sa [1-4] 0
cc-by-nc | cc by nc [1-4] 0
ofl-1.1 | ofl 1 1
wtfpl | wtfpl
postgresql | postgresql
ncsa | ncsa
python-2 | (?:psf|python) 2 0
artistic-2 | artistic 2 0
classpath-exception | classpath exception 2 0
gcc-exception | gcc exception 3 1
llvm-exception | llvm exception
"""


def lines(table: str) -> list[tuple[str, ...]]:
    """Label, keyword and pattern of each line; a ``-`` or nothing for the pattern means the keyword itself."""
    rows = [tuple(p.strip() for p in line.split(" | ")) for line in table.strip().splitlines()]
    return [r if len(r) > 2 and r[2] != "-" else (r[0], r[1], r[1]) for r in rows]


def spdx_rules() -> list[tuple[str, str]]:
    """Label and pattern of each identifier as a later operand of an expression, and as one with its version spelled out.

    An expression is a row of identifiers with AND, OR or WITH between; brackets are no words.
    """
    names = [(label, pattern) for label, pattern, *_ in (tuple(p.strip() for p in x.split(" | ")) for x in SPDX.strip().splitlines())]
    any_name = "|".join(pattern for _, pattern in sorted(names, key=lambda r: -len(r[1])))
    before = f"(?:(?:{any_name}) (?:and|or|with) )*"
    return [(label, f"spdx license identifier {before}{pattern}") for label, pattern in names]


def identifiers() -> list[tuple[str, str, str]]:
    """Label, keyword and pattern of identifiers that are clear enough to stand alone: those that end in "only" or "or later"."""
    out = []
    for label, pattern in ((r[0], r[1]) for r in lines(SPDX)):
        if "or later" in pattern:
            stem = pattern.split("(?:")[0]
            out += [(label, f"{stem} {end}", f"{stem} {end}") for end in ("only", "or later")]
    return out
