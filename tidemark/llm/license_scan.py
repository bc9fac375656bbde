"""License scans: ordered signature rules over whole texts.

A rule is a regular expression with a label, a priority and a keyword without which it cannot match. A rule runs
only on texts that hold its keyword. Its matches are detections (start, end) with the rule's priority; a
detection that lies within another of higher priority (or of the same priority and greater length) is
suppressed. Detections that merely overlap both stay. Base phrases, whose words stand consecutively, are found
by their own rules and are never suppressed.

The rules come from the tables below, written by hand: for each license its names, SPDX identifiers and addresses, sentences of
its text, and expressions for what people write instead: ranges of versions, "or later", exceptions, abbreviated and reordered notices.

Defined results: a null text is empty; without words there is no detection; repeated rows each give a row; other
columns are ignored; an empty table gives no rows. A text may have any length and any number of detections: each expression runs
over it once, gaps between words are matched without going back, and suppression sorts. One pass over the texts, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.texts import map_batches, to_batch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = re.compile(WORD + "+")
_LOWER = {c: c + 32 for c in range(65, 91)}
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: label: SPDX identifiers | names | addresses. Names are in words; # stands for an optional "version" or "v".
LICENSES = """
mit: MIT | expat license; massachusetts institute of technology license; mit licence; x11 license | opensource.org/licenses/mit
mit-0: MIT-0 | mit no attribution; mit zero license | opensource.org/licenses/mit-0
apache-1.0: Apache-1.0 | apache license # 1.0; apache software license # 1.0 | apache.org/licenses/license-1.0
apache-1.1: Apache-1.1 | apache license # 1.1; apache software license # 1.1 | apache.org/licenses/license-1.1
apache-2.0: Apache-2.0 | apache license # 2.0; apache software license # 2.0; apache 2.0 license; asl 2.0 | apache.org/licenses/license-2.0; opensource.org/licenses/apache-2.0
gpl-1.0: GPL-1.0; GPL-1.0-only; GPL-1.0-or-later | general public license # 1; general public license # 1.0 | gnu.org/licenses/gpl-1.0
gpl-2.0: GPL-2.0; GPL-2.0-only; GPL-2.0-or-later; GPL-2.0+ | general public license # 2; general public license # 2.0; gplv2; gpl v2; gnu gpl 2 | gnu.org/licenses/gpl-2.0; gnu.org/licenses/old-licenses/gpl-2.0
gpl-3.0: GPL-3.0; GPL-3.0-only; GPL-3.0-or-later; GPL-3.0+ | general public license # 3; general public license # 3.0; gplv3; gpl v3; gnu gpl 3 | gnu.org/licenses/gpl-3.0; opensource.org/licenses/gpl-3.0
lgpl-2.0: LGPL-2.0; LGPL-2.0-only; LGPL-2.0-or-later | library general public license # 2; library general public license # 2.0 | gnu.org/licenses/lgpl-2.0
lgpl-2.1: LGPL-2.1; LGPL-2.1-only; LGPL-2.1-or-later; LGPL-2.1+ | lesser general public license # 2.1; lgplv2.1; lgpl v2.1 | gnu.org/licenses/lgpl-2.1; gnu.org/licenses/old-licenses/lgpl-2.1
lgpl-3.0: LGPL-3.0; LGPL-3.0-only; LGPL-3.0-or-later; LGPL-3.0+ | lesser general public license # 3; lesser general public license # 3.0; lgplv3; lgpl v3 | gnu.org/licenses/lgpl-3.0
agpl-3.0: AGPL-3.0; AGPL-3.0-only; AGPL-3.0-or-later | affero general public license # 3; affero general public license # 3.0; agplv3; agpl v3 | gnu.org/licenses/agpl-3.0; opensource.org/licenses/agpl-3.0
gfdl: GFDL-1.1; GFDL-1.2; GFDL-1.3; GFDL-1.3-only; GFDL-1.3-or-later | gnu free documentation license; free documentation license # 1.3; free documentation license # 1.2 | gnu.org/licenses/fdl
bsd-2-clause: BSD-2-Clause; BSD-2-Clause-Patent | bsd 2 clause license; two clause bsd license; simplified bsd license; freebsd license | opensource.org/licenses/bsd-2-clause
bsd-3-clause: BSD-3-Clause; BSD-3-Clause-Clear | bsd 3 clause license; three clause bsd license; new bsd license; modified bsd license; revised bsd license | opensource.org/licenses/bsd-3-clause; opensource.org/licenses/bsd-license
bsd-4-clause: BSD-4-Clause; BSD-4-Clause-UC | bsd 4 clause license; four clause bsd license; original bsd license | spdx.org/licenses/bsd-4-clause
0bsd: 0BSD | zero clause bsd license; bsd zero clause license | opensource.org/licenses/0bsd
isc: ISC | isc license; internet systems consortium license | opensource.org/licenses/isc
mpl-1.1: MPL-1.0; MPL-1.1 | mozilla public license # 1.0; mozilla public license # 1.1 | mozilla.org/mpl/1.1; mozilla.org/mpl/mpl-1.1
mpl-2.0: MPL-2.0; MPL-2.0-no-copyleft-exception | mozilla public license # 2.0; mplv2 | mozilla.org/mpl/2.0; opensource.org/licenses/mpl-2.0
epl-1.0: EPL-1.0 | eclipse public license # 1.0 | eclipse.org/legal/epl-v10
epl-2.0: EPL-2.0 | eclipse public license # 2.0 | eclipse.org/legal/epl-2.0
cddl-1.0: CDDL-1.0 | common development and distribution license # 1.0; common development and distribution license | opensource.org/licenses/cddl-1.0
cddl-1.1: CDDL-1.1 | common development and distribution license # 1.1 | spdx.org/licenses/cddl-1.1
cpl-1.0: CPL-1.0 | common public license # 1.0 | opensource.org/licenses/cpl1.0
eupl-1.1: EUPL-1.1 | european union public licence # 1.1 | spdx.org/licenses/eupl-1.1
eupl-1.2: EUPL-1.2 | european union public licence # 1.2 | spdx.org/licenses/eupl-1.2
artistic-1.0: Artistic-1.0; Artistic-1.0-Perl | artistic license # 1.0 | opensource.org/licenses/artistic-license-1.0
artistic-2.0: Artistic-2.0 | artistic license # 2.0 | opensource.org/licenses/artistic-2.0
bsl-1.0: BSL-1.0 | boost software license # 1.0; boost software license | boost.org/license_1_0
zlib: Zlib | zlib license; zlib libpng license | opensource.org/licenses/zlib; zlib.net/zlib_license
libpng: Libpng; libpng-2.0 | png reference library license; libpng license | libpng.org/pub/png/src/libpng-license
unlicense: Unlicense | the unlicense | unlicense.org
wtfpl: WTFPL | do what the fuck you want to public license | wtfpl.net
cc0-1.0: CC0-1.0 | cc0 1.0 universal; creative commons zero # 1.0 | creativecommons.org/publicdomain/zero/1.0
cc-by-1.0: CC-BY-1.0 | cc by 1.0; creative commons attribution 1.0 | creativecommons.org/licenses/by/1.0
cc-by-2.0: CC-BY-2.0 | cc by 2.0; creative commons attribution 2.0 | creativecommons.org/licenses/by/2.0
cc-by-2.5: CC-BY-2.5 | cc by 2.5; creative commons attribution 2.5 | creativecommons.org/licenses/by/2.5
cc-by-3.0: CC-BY-3.0 | cc by 3.0; creative commons attribution 3.0 | creativecommons.org/licenses/by/3.0
cc-by-4.0: CC-BY-4.0 | cc by 4.0; creative commons attribution 4.0 | creativecommons.org/licenses/by/4.0
cc-by-sa-2.0: CC-BY-SA-2.0 | cc by sa 2.0; creative commons attribution sharealike 2.0 | creativecommons.org/licenses/by-sa/2.0
cc-by-sa-2.5: CC-BY-SA-2.5 | cc by sa 2.5; creative commons attribution sharealike 2.5 | creativecommons.org/licenses/by-sa/2.5
cc-by-sa-3.0: CC-BY-SA-3.0 | cc by sa 3.0; creative commons attribution sharealike 3.0 | creativecommons.org/licenses/by-sa/3.0
cc-by-sa-4.0: CC-BY-SA-4.0 | cc by sa 4.0; creative commons attribution sharealike 4.0 | creativecommons.org/licenses/by-sa/4.0
cc-by-nd-3.0: CC-BY-ND-3.0 | cc by nd 3.0; creative commons attribution noderivatives 3.0 | creativecommons.org/licenses/by-nd/3.0
cc-by-nd-4.0: CC-BY-ND-4.0 | cc by nd 4.0; creative commons attribution noderivatives 4.0 | creativecommons.org/licenses/by-nd/4.0
cc-by-nc-2.0: CC-BY-NC-2.0 | cc by nc 2.0; creative commons attribution noncommercial 2.0 | creativecommons.org/licenses/by-nc/2.0
cc-by-nc-3.0: CC-BY-NC-3.0 | cc by nc 3.0; creative commons attribution noncommercial 3.0 | creativecommons.org/licenses/by-nc/3.0
cc-by-nc-4.0: CC-BY-NC-4.0 | cc by nc 4.0; creative commons attribution noncommercial 4.0 | creativecommons.org/licenses/by-nc/4.0
cc-by-nc-sa-3.0: CC-BY-NC-SA-3.0 | cc by nc sa 3.0; creative commons attribution noncommercial sharealike 3.0 | creativecommons.org/licenses/by-nc-sa/3.0
cc-by-nc-sa-4.0: CC-BY-NC-SA-4.0 | cc by nc sa 4.0; creative commons attribution noncommercial sharealike 4.0 | creativecommons.org/licenses/by-nc-sa/4.0
cc-by-nc-nd-3.0: CC-BY-NC-ND-3.0 | cc by nc nd 3.0; creative commons attribution noncommercial noderivatives 3.0 | creativecommons.org/licenses/by-nc-nd/3.0
cc-by-nc-nd-4.0: CC-BY-NC-ND-4.0 | cc by nc nd 4.0; creative commons attribution noncommercial noderivatives 4.0 | creativecommons.org/licenses/by-nc-nd/4.0
odbl-1.0: ODbL-1.0 | open database license # 1.0; open data commons open database license | opendatacommons.org/licenses/odbl
odc-by-1.0: ODC-By-1.0 | open data commons attribution license | opendatacommons.org/licenses/by
pddl-1.0: PDDL-1.0 | public domain dedication and license | opendatacommons.org/licenses/pddl
ofl-1.1: OFL-1.0; OFL-1.1 | sil open font license # 1.1; sil open font license | scripts.sil.org/ofl; openfontlicense.org
python-2.0: PSF-2.0; Python-2.0 | python software foundation license # 2; python software foundation license | docs.python.org/3/license
php-3.01: PHP-3.0; PHP-3.01 | php license # 3.01; php license # 3.0 | php.net/license/3_01
ruby: Ruby | ruby license | ruby-lang.org/en/about/license
vim: Vim | vim license | vimhelp.org/uganda.txt
openssl: OpenSSL | openssl license; openssl ssleay license | openssl.org/source/license
postgresql: PostgreSQL | postgresql license; postgresql licence | opensource.org/licenses/postgresql
afl-3.0: AFL-2.1; AFL-3.0 | academic free license # 3.0; academic free license # 2.1 | opensource.org/licenses/afl-3.0
osl-3.0: OSL-2.1; OSL-3.0 | open software license # 3.0; open software license # 2.1 | opensource.org/licenses/osl-3.0
ms-pl: MS-PL | microsoft public license | opensource.org/licenses/ms-pl
ms-rl: MS-RL | microsoft reciprocal license | opensource.org/licenses/ms-rl
lppl-1.3c: LPPL-1.0; LPPL-1.3c | latex project public license # 1.3; latex project public license | latex-project.org/lppl
ncsa: NCSA | university of illinois ncsa open source license | opensource.org/licenses/ncsa
upl-1.0: UPL-1.0 | universal permissive license # 1.0 | opensource.org/licenses/upl
qpl-1.0: QPL-1.0 | q public license # 1.0 | opensource.org/licenses/qtpl
sleepycat: Sleepycat | sleepycat license | opensource.org/licenses/sleepycat
w3c: W3C | w3c software notice and license; w3c software license | w3.org/consortium/legal/copyright-software
unicode-dfs: Unicode-DFS-2015; Unicode-DFS-2016; Unicode-3.0 | unicode license # 3; unicode license agreement | unicode.org/copyright; unicode.org/license
sspl-1.0: SSPL-1.0 | server side public license # 1 | mongodb.com/licensing/server-side-public-license
busl-1.1: BUSL-1.1 | business source license # 1.1 | mariadb.com/bsl11
elastic-2.0: Elastic-2.0 | elastic license # 2.0 | elastic.co/licensing/elastic-license
polyform: PolyForm-Noncommercial-1.0.0; PolyForm-Small-Business-1.0.0 | polyform noncommercial license; polyform small business license | polyformproject.org/licenses
mulan-2.0: MulanPSL-2.0 | mulan permissive software license # 2 | license.coscl.org.cn/mulanpsl2
blueoak-1.0.0: BlueOak-1.0.0 | blue oak model license | blueoakcouncil.org/license/1.0.0
openrail: OpenRAIL; CreativeML-OpenRAIL-M | creativeml open rail m; responsible ai license | huggingface.co/spaces/compvis/stable-diffusion-license
"""

#: label: a sentence of the license's text or of the notices that name it.
NOTICES = """
mit: permission is hereby granted free of charge to any person obtaining a copy of this software
isc: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd: redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause: neither the name of the copyright holder nor the names of its contributors may be used
bsd-4-clause: all advertising materials mentioning features or use of this software must display
apache-2.0: you may not use this file except in compliance with the license
gpl: you can redistribute it and or modify it under the terms of the gnu general public license
lgpl: you can redistribute it and or modify it under the terms of the gnu lesser general public license
agpl: you can redistribute it and or modify it under the terms of the gnu affero general public license
mpl-2.0: this source code form is subject to the terms of the mozilla public license
unlicense: this is free and unencumbered software released into the public domain
bsl-1.0: permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
zlib: this software is provided as is without any express or implied warranty in no event will the authors be held liable
cc: this work is licensed under a creative commons
cc: licensed under the creative commons
cc0: to the extent possible under law the author has waived all copyright
public-domain: released into the public domain
public-domain: this work is in the public domain
proprietary: all rights reserved
proprietary: unauthorized copying of this file via any medium is strictly prohibited
gpl: licensed under the gpl
lgpl: licensed under the lgpl
agpl: licensed under the agpl
gpl: gnu general public license
lgpl: lesser general public license
lgpl: library general public license
agpl: affero general public license
bsd: bsd license
bsd: bsd style license
mpl: mozilla public license
epl: eclipse public license
artistic: artistic license
cc-by-nc: cc by nc
cc-by-sa: cc by sa
cc-by-nd: cc by nd
cc-by-nc-sa: cc by nc sa
cc-by-nc-nd: cc by nc nd
mit: released under the mit license
mit: licensed under the mit license
mit: distributed under the mit license
mit: terms of the mit license
apache: licensed under the apache license
apache: released under the apache license
apache: terms of the apache license
"""


#: label: priority: keyword: expression. A space stands for what lies between words; the keyword is part of every match.
EXPRESSIONS = """
gpl-2.0-or-later: 75: later: (?:gnu )?(?:general public license|gpl)(?: (?:version|v))? ?v?2(?: 0)?(?: or)?(?: at your option)?(?: any)? later(?: versions?)?
gpl-3.0-or-later: 75: later: (?:gnu )?(?:general public license|gpl)(?: (?:version|v))? ?v?3(?: 0)?(?: or)?(?: at your option)?(?: any)? later(?: versions?)?
lgpl-2.1-or-later: 75: later: (?:gnu )?(?:lesser general public license|lgpl)(?: (?:version|v))? ?v?2 1(?: or)?(?: at your option)?(?: any)? later(?: versions?)?
lgpl-3.0-or-later: 75: later: (?:gnu )?(?:lesser general public license|lgpl)(?: (?:version|v))? ?v?3(?: 0)?(?: or)?(?: at your option)?(?: any)? later(?: versions?)?
agpl-3.0-or-later: 75: later: (?:gnu )?(?:affero general public license|agpl)(?: (?:version|v))? ?v?3(?: 0)?(?: or)?(?: at your option)?(?: any)? later(?: versions?)?
gpl-2.0-only: 75: only: (?:gnu )?(?:general public license|gpl)(?: (?:version|v))? ?v?2(?: 0)? only
gpl-3.0-only: 75: only: (?:gnu )?(?:general public license|gpl)(?: (?:version|v))? ?v?3(?: 0)? only
lgpl-2.1-only: 75: only: (?:gnu )?(?:lesser general public license|lgpl)(?: (?:version|v))? ?v?2 1 only
gpl-2.0-or-later: 75: either version 2: general public license as published by the free software foundation either version 2(?: 0)? of the license or at your option any later version
gpl-3.0-or-later: 75: either version 3: general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version
lgpl-2.1-or-later: 75: either version 2.1: lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
agpl-3.0-or-later: 75: affero: affero general public license as published by the free software foundation either version 3(?: 0)? of the license or at your option any later version
classpath-exception: 78: classpath: (?:with(?: the)? )?(?:gnu )?classpath(?: linking)? exceptions?
gcc-exception: 78: gcc: (?:with(?: the)? )?gcc runtime library exceptions?
autoconf-exception: 78: autoconf: (?:with(?: the)? )?autoconf(?: macro| configure script)? exceptions?
bison-exception: 78: bison: (?:with(?: the)? )?bison(?: parser)? exceptions?
font-exception: 78: font: (?:with(?: the)? )?(?:gpl )?font(?: embedding)? exceptions?
openssl-exception: 78: openssl: (?:with(?: the| an)? )?openssl(?: linking)? exceptions?
llvm-exception: 78: llvm: (?:apache license(?: version)? ?v?2 0 )?with llvm exceptions?
linking-exception: 78: linking: (?:with (?:a |the )?)?(?:special |static )?linking exceptions?
syscall-note: 78: syscall: (?:with )?linux syscall note
apache-2.0: 74: apache: (?:licensed|released|distributed|available|published) under(?: the)?(?: terms of(?: the)?)? apache(?: software)?(?: licen[sc]e)?(?: (?:version|v))? ?v?2(?: 0)?
apache-2.0: 62: limitations: see the license for the specific language governing permissions and limitations under the license
apache-2.0: 62: warranties or conditions: distributed on an as is basis without warranties or conditions of any kind
apache: 55: apache: apache(?: style| like| type) licen[sc]es?
mit: 74: mit: (?:licensed|released|distributed|available|published|covered) (?:under|by)(?: the)?(?: terms of(?: the)?)?(?: permissive)? mit(?: x11)? licen[sc]e
mit: 74: mit: mit(?: x11| expat)? licen[sc]ed?
mit: 55: mit: mit(?: style| like| type) licen[sc]es?
mit: 62: noninfringement: warranties of merchantability fitness for a particular purpose and noninfringement
mit: 62: substantial: above copyright notice and this permission notice shall be included in all copies or substantial portions
mit: 62: liable: in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit-or-apache-2.0: 79: apache: (?:dual(?:ly)? )?licen[sc]ed? under (?:either (?:of )?)?(?:the )?(?:mit (?:licen[sc]e )?(?:or|and)(?: the)? apache|apache(?: licen[sc]e)?(?: (?:version|v))?(?: ?v?2(?: 0)?)? (?:or|and)(?: the)? mit)(?: licen[sc]e)?
bsd-2-clause: 74: bsd: (?:bsd )?(?:2|two) clause(?: bsd)?(?: licen[sc]e)?|bsd 2
bsd-3-clause: 74: bsd: (?:3|three) clause bsd(?: licen[sc]e)?|bsd (?:3|three) clause(?: licen[sc]e)?|bsd 3
bsd: 72: bsd: (?:licensed|released|distributed|available|published) under(?: the| a)?(?: terms of(?: the)?)?(?: permissive)? bsd(?: style)?(?: licen[sc]e)?
bsd: 55: bsd: bsd(?: style| like| type| licen[sc]ed?)+
bsd: 62: redistributions: redistributions (?:of source code must retain|in binary form must reproduce) the above copyright notice
bsd: 62: contributors: this software is provided by the (?:copyright holders? and contributors|regents and contributors|authors?) as is
isc: 74: isc: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? isc(?: licen[sc]e)?
mpl-2.0: 74: mozilla: (?:licensed|released|distributed|available) under(?: the)?(?: terms of(?: the)?)? (?:mozilla public licen[sc]e|mozilla)(?: (?:version|v))? ?v?2(?: 0)?
mpl-2.0: 62: mpl was not: if a copy of the mpl was not distributed with this file
epl-2.0: 74: eclipse: eclipse public licen[sc]e(?: (?:version|v))? ?v?2(?: 0)?
epl-1.0: 74: eclipse: eclipse public licen[sc]e(?: (?:version|v))? ?v?1(?: 0)?
gpl: 72: gpl: (?:licensed|released|distributed|available|published|covered) (?:under|by)(?: the)?(?: terms of(?: the)?)?(?: gnu)? gpl
gpl: 55: gpl: gpl(?: compatible| licen[sc]ed?)
lgpl: 55: lgpl: (?:gnu )?lgpl(?: licen[sc]ed?)?
agpl: 55: agpl: (?:gnu )?agpl(?: licen[sc]ed?)?
gfdl: 74: documentation: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e
cc-by: 74: creative commons: creative commons attribution(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)? licen[sc]e
cc-by-sa: 74: creative commons: creative commons attribution share ?alike(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nc: 74: creative commons: creative commons attribution non ?commercial(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nd: 74: creative commons: creative commons attribution no ?deriv(?:ative|ative works?|atives|s)?(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nc-sa: 76: creative commons: creative commons attribution non ?commercial share ?alike(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc-by-nc-nd: 76: creative commons: creative commons attribution non ?commercial no ?deriv(?:ative|ative works?|atives|s)?(?: ?(?:1|2|2 5|3|4) 0)?(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?
cc0: 72: cc0: (?:licensed|released|available|dedicated|marked) (?:under|with|to)(?: the)? cc0(?: 1 0)?(?: universal)?
public-domain: 62: public domain: (?:is |are |been )?(?:placed|put|dedicated|released|donated|given) (?:in|to|into) the public domain
public-domain: 62: public domain: (?:author|authors|i|we) (?:hereby )?(?:disclaims?|waives?|abandons?) (?:all )?copyrights?(?: to this (?:source code|software|work))?(?: and (?:release|place)s? it (?:in|to|into) the public domain)
unlicense: 74: unlicense: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? unlicense
wtfpl: 74: wtfpl: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? wtfpl(?: (?:version|v))?(?: ?v?2)?
boost: 74: boost: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? boost software licen[sc]e
zlib: 74: zlib: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? zlib(?: libpng)?(?: licen[sc]e)?
zlib: 62: altered: altered source versions must be plainly marked as such
ofl-1.1: 74: open font: (?:this font software is )?licensed under the sil open font licen[sc]e(?: (?:version|v))?(?: ?v?1 1)?
artistic: 74: artistic: licensed under(?: the)?(?: terms of(?: the)?)? artistic licen[sc]e
perl: 72: perl: (?:under )?(?:the )?same terms as perl(?: 5)?(?: itself)?
python-2.0: 72: python: (?:licensed|released|distributed) under(?: the)?(?: terms of(?: the)?)? python(?: software foundation)? licen[sc]e
proprietary: 58: proprietary: (?:confidential and proprietary|proprietary and confidential|proprietary licen[sc]e)
proprietary: 58: redistribution: (?:no|without) redistribution(?: is)?(?: permitted| allowed)?
commercial: 58: commercial: commercial licen[sc]e(?: agreement)?
non-commercial: 58: non: for (?:research|academic|educational|personal)(?: and (?:research|academic|educational|personal))?(?: or)? non ?commercial (?:use|purposes?) only
see-license: 52: licen: (?:see|refer to) (?:the )?(?:accompanying |included |file )?licen[sc]e(?: (?:txt|md|file))? for (?:the )?(?:full )?(?:details|licen[sc]e|text|terms|information|more information)
openrail: 74: openrail: (?:creativeml )?openrail(?: m| plus plus| pp)?(?: licen[sc]e)?
llama: 74: llama: (?:meta )?llama(?: 2| 3| 3 1)? community licen[sc]e(?: agreement)?
gemma: 74: gemma: gemma terms of use
"""


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    confidence: float
    base: bool = False


def _phrase(words: str) -> str:
    """Words with anything but word characters between them; # is an optional "version" or "v"."""
    out, first = "", True
    for word in words.split():
        if word == "#":
            out += rf"(?:{GAP}(?:version|v))?"
            continue
        spelt = GAP.join(map(re.escape, re.findall(r"[^.]+", word)))  # 2.0 is two words
        if not first and re.match("[0-9]", word):
            spelt = "v?" + spelt
        out += ("" if first else GAP) + spelt
        first = False
    return rf"(?<!{WORD}){out}(?!{WORD})"


def _expression(words: str) -> str:
    """A hand-written expression whose spaces stand for what lies between words."""
    return rf"(?<!{WORD})(?:{words.replace(' ?', GAP[:-1] + '*+').replace(' ', GAP + '+')})(?!{WORD})"


def _keyword(words: str) -> str:
    """The longest word, which every match holds as it stands."""
    return max((part for word in words.split() if word != "#" for part in word.split(".")), key=len)


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first."""
    found = [Rule(label, 0, phrase.split()[0], _phrase(phrase), 1.0, True) for phrase, label in BASE]
    for line in LICENSES.strip().splitlines():
        label, _, rest = line.partition(": ")
        ids, names, urls = ([x.strip() for x in part.split(";")] for part in rest.split(" | "))
        for tag in ids:
            found.append(Rule(label, 100, "spdx", r"spdx-license-identifier:[ \t]*\(?" + re.escape(tag.lower()) + r"(?![\w.+-])", 1.0))
            found.append(Rule(label, 90, "license", r"license[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?" + re.escape(tag.lower()) + r"(?![\w.+-])", 0.9))
        for url in urls:
            found.append(Rule(label, 80, url, r"(?<![\w.-])(?:https?://)?(?:www\.)?" + re.escape(url), 0.95))
        for name in names:
            found.append(Rule(label, 70, _keyword(name), _phrase(name), 0.9))
    for line in NOTICES.strip().splitlines():
        label, _, text = line.partition(": ")
        found.append(Rule(label, 60 if len(text.split()) > 6 else 50, _keyword(text), _phrase(text), 0.85 if len(text.split()) > 6 else 0.7))
    for line in EXPRESSIONS.strip().splitlines():
        label, priority, keyword, pattern = line.split(": ", 3)
        found.append(Rule(label, int(priority), keyword.split()[0], _expression(pattern), 0.9 if int(priority) >= 70 else 0.7))
    return tuple(sorted(found, key=lambda r: -r.priority))


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int
    confidence: float
    base: bool


def suppress(found: list[Detection]) -> list[Detection]:
    """Without those that lie within one of higher priority, or of the same priority and greater length, in the order of priority and place.

    Detections are sorted by start; one lies within another if the furthest end of those that start no later reaches its own.
    """
    order = sorted(found, key=lambda d: (-d.priority, d.start, -d.end, d.label))
    if len(order) < 2:
        return order
    starts, ends, priorities = (np.array([getattr(d, name) for d in order]) for name in ("start", "end", "priority"))
    gone = np.zeros(len(order), bool)
    above: list[tuple[np.ndarray, np.ndarray]] = []
    for own in np.split(np.arange(len(order)), np.flatnonzero(np.diff(priorities)) + 1):
        s, e = starts[own], ends[own]
        reach = np.maximum.accumulate(e)
        first = np.maximum.accumulate(np.where(np.diff(s, prepend=-1).astype(bool) | np.diff(e, prepend=-1).astype(bool), np.arange(len(own)), 0))  # of equal places
        gone[own] = (first > 0) & (reach[first - 1] >= e)
        for higher_starts, higher_reach in above:
            at = np.searchsorted(higher_starts, s, side="right") - 1
            gone[own] |= (at >= 0) & (higher_reach[at] >= e)
        above.append((s, reach))
    return [d for d, lost in zip(order, gone.tolist()) if not lost]


class Scanner:
    """The rules, compiled, behind their keywords."""

    def __init__(self):
        self.by_keyword: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        for rule in rules():
            self.by_keyword.setdefault(rule.keyword, []).append((rule, re.compile(rule.pattern)))
        import ahocorasick

        self.gate = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.gate.add_word(keyword, keyword)
        self.gate.make_automaton()

    def detections(self, lowered: str) -> list[Detection]:
        """Base detections, then those of the other rules that nothing suppresses."""
        base, other = [], []
        for keyword in sorted({k for _, k in self.gate.iter(lowered)}):
            for rule, pattern in self.by_keyword[keyword]:
                for m in pattern.finditer(lowered):
                    (base if rule.base else other).append(Detection(m.start(), m.end(), rule.label, rule.priority, rule.confidence, rule.base))
        return sorted(base, key=lambda d: d.start) + suppress(other)

    def scan(self, text: str | None) -> dict[str, object]:
        lowered = (text or "").translate(_LOWER) if not (text or "").isascii() else text.lower() if text else ""
        found = self.detections(lowered)
        base = [d for d in found if d.base]
        starts = [count_words(lowered[: d.start]) for d in (base[:1] + base[-1:])]
        return {
            "n_words": count_words(lowered),
            "n_base": len(base),
            "first_word": starts[0] if starts else None,
            "last_word": starts[1] if starts else None,
            "base_labels": ",".join(sorted({d.label for d in base})),
            "labels": ",".join(sorted({d.label for d in found})),
            "score": max((d.confidence for d in found), default=0.0),
            "detections": len(found),
        }


def count_words(lowered: str) -> int:
    return len(_WORDS.findall(lowered))


TYPES = {
    "doc_id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "detections": pa.int64(),
}
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections long"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in batches:
        rows = [scanner.scan(t) for t in batch.column("text").to_pylist()]
        columns = {name: [row[name] for row in rows] for name in TYPES if name != "doc_id"}
        yield to_batch({"doc_id": batch.column("doc_id")} | columns, TYPES)


def scan_documents(documents: DataFrame) -> DataFrame:
    """A row for each document with its base and rule labels."""
    return map_batches(documents.select("doc_id", "text"), _scan_batches, SCHEMA)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license labels."""
    return scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

