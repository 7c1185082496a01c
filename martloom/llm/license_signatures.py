"""Signatures of licences: hand-written regular expressions in the order of their priority.

A line is a label, a certainty, keywords, and a pattern over lower-cased words joined by single
spaces (punctuation is not there: "GPL-2.0" is "gpl 2 0"). A text needs one of the keywords, which "|"
parts; all words of one that "+" joins. A word in angle brackets stands for a part that many
patterns share. Where detections overlap and neither holds the other, the line that comes first wins.
"""

from __future__ import annotations

#: Parts of patterns.
PARTS = {
    "<lic>": r"licen[cs]e",
    # A grant up to the licence's name.
    "<under>": (
        r"(?:(?:dual |double |tri )?licen[cs]ed|released|distributed|available|published|provided|"
        r"redistributed|made available|covered|offered) (?:under|according to)(?: either)?(?: the)?"
        r"(?: terms(?: and conditions)? of)?(?: either)?(?: the| an?)?"
    ),
    # A field that names a licence, as in metadata: "license: X", "license type X".
    "<field>": r"licen[cs]e(?:s|d)?(?: is| type| name| id| identifier| file)?",
    # A version after the name: "version 2", "v2", "2 0".
    "<v>": r"(?: (?:version |ver |v )?v?",
    "<later>": r"(?:(?: only| or(?: at your option)?(?: any)?(?: later|newer)(?: versions?)?| plus))?",
}

#: What a text says of itself in a machine-readable tag. The names of the SPDX list.
TAGS = """
gpl            0.99  spdx  spdx <lic> identifier gpl [123] 0(?: only| or later)?
lgpl           0.99  spdx  spdx <lic> identifier lgpl [23] [01](?: only| or later)?
agpl           0.99  spdx  spdx <lic> identifier agpl [13] 0(?: only| or later)?
gfdl           0.99  spdx  spdx <lic> identifier gfdl 1 [123](?: (?:no )?invariants)?(?: only| or later)?
apache         0.99  spdx  spdx <lic> identifier apache (?:1 [01]|2 0)
mit            0.99  spdx  spdx <lic> identifier mit(?: 0| cmu| feh| modern variant)?
x11            0.99  spdx  spdx <lic> identifier x11
bsd-0-clause   0.99  spdx  spdx <lic> identifier 0bsd
bsd-1-clause   0.99  spdx  spdx <lic> identifier bsd 1 clause
bsd-2-clause   0.99  spdx  spdx <lic> identifier bsd 2 clause(?: patent| views)?
bsd-3-clause   0.99  spdx  spdx <lic> identifier bsd 3 clause(?: clear| lbnl| attribution)?
bsd-4-clause   0.99  spdx  spdx <lic> identifier bsd 4 clause(?: uc)?
isc            0.99  spdx  spdx <lic> identifier isc
mpl            0.99  spdx  spdx <lic> identifier mpl (?:1 [01]|2 0)(?: no copyleft exception)?
epl            0.99  spdx  spdx <lic> identifier epl [12] 0
eupl           0.99  spdx  spdx <lic> identifier eupl 1 [012]
cddl           0.99  spdx  spdx <lic> identifier cddl 1 [01]
artistic       0.99  spdx  spdx <lic> identifier artistic [12] 0(?: perl| cl8)?
zlib           0.99  spdx  spdx <lic> identifier zlib(?: acknowledgement)?
libpng         0.99  spdx  spdx <lic> identifier libpng(?: 2 0)?
boost          0.99  spdx  spdx <lic> identifier bsl 1 0
busl           0.99  spdx  spdx <lic> identifier busl 1 1
sspl           0.99  spdx  spdx <lic> identifier sspl 1 0
elastic        0.99  spdx  spdx <lic> identifier elastic 2 0
unlicense      0.99  spdx  spdx <lic> identifier unlicense
wtfpl          0.99  spdx  spdx <lic> identifier wtfpl
python         0.99  spdx  spdx <lic> identifier (?:python|psf) 2 0(?: 1)?
openssl        0.99  spdx  spdx <lic> identifier openssl
curl           0.99  spdx  spdx <lic> identifier curl
ncsa           0.99  spdx  spdx <lic> identifier ncsa
postgresql     0.99  spdx  spdx <lic> identifier postgresql
ofl            0.99  spdx  spdx <lic> identifier ofl 1 [01](?: no rfn| rfn)?
cc0            0.99  spdx  spdx <lic> identifier cc0 1 0
cc-by-nc-nd    0.99  spdx  spdx <lic> identifier cc by nc nd [1234] [05]
cc-by-nc-sa    0.99  spdx  spdx <lic> identifier cc by nc sa [1234] [05]
cc-by-nc       0.99  spdx  spdx <lic> identifier cc by nc [1234] [05]
cc-by-nd       0.99  spdx  spdx <lic> identifier cc by nd [1234] [05]
cc-by-sa       0.99  spdx  spdx <lic> identifier cc by sa [1234] [05]
cc-by          0.99  spdx  spdx <lic> identifier cc by [1234] [05]
odbl           0.99  spdx  spdx <lic> identifier odbl 1 0
ms-pl          0.99  spdx  spdx <lic> identifier ms pl
upl            0.99  spdx  spdx <lic> identifier upl 1 0
"""

#: Sentences of the licences' own texts and notices.
TEXTS = """
gpl            0.95  gnu  this program is free software you can redistribute it and or modify it under the terms of the gnu general public <lic>
gpl            0.95  gnu  (?:it|and or modify it) under the terms of the gnu general public <lic> as published by the free software foundation
gpl            0.9   either+later  either version [123](?: 0)? of the <lic> or at your option any later version
gpl            0.9   gpl|gnu  you should have received a copy of the (?:gnu general public <lic>|gpl|gnu gpl) along with this (?:program|software|library|file|package)
gpl            0.9   copyleft  the gnu general public <lic> is a free copyleft <lic> for software and other kinds of works
gpl            0.9   gnu  gnu general public <lic> version [123] (?:june 1991|29 june 2007|february 1989)
gpl            0.85  foundation+inc  free software foundation inc (?:59 temple place|51 franklin street|675 mass ave)
lgpl           0.95  lesser  under the terms of the gnu lesser general public <lic> as published by the free software foundation
lgpl           0.95  library+gnu  under the terms of the gnu library general public <lic> as published by the free software foundation
lgpl           0.9   lesser  you should have received a copy of the gnu lesser general public <lic> along with this (?:program|software|library|file|package)
lgpl           0.9   lesser  this version of the gnu lesser general public <lic> incorporates the terms and conditions of version 3
agpl           0.95  affero  under the terms of the gnu affero general public <lic> as published by(?: the free software foundation)?
agpl           0.9   affero  you should have received a copy of the gnu affero general public <lic> along with this (?:program|software|library|file|package)
gfdl           0.95  documentation+gnu  permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation <lic>
apache         0.97  apache  licensed under the apache <lic> version 2 0 the <lic> you may not use this file except in compliance with the <lic>
apache         0.9   compliance+obtain  you may not use this file except in compliance with the <lic> you may obtain a copy of the <lic> at
apache         0.85  basis+warranties  distributed under the <lic> is distributed on an as is basis without warranties or conditions of any kind
apache         0.9   asf  licensed to the apache software foundation asf under one or more contributor <lic> agreements
apache         0.9   apache  this product includes software developed (?:by|at) the apache (?:software foundation|group)
apache         0.85  apache  terms and conditions for use reproduction and distribution 1 definitions (?:\\w+ ){0,40}apache
mit            0.97  deal+hereby  permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit            0.93  sublicense  (?:the rights to )?use copy modify merge publish distribute sublicense and or sell copies of the software
mit            0.9   permission+portions  the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit            0.85  noninfringement  including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders
x11            0.9   consortium+advertising  the name of the x consortium shall not be used in advertising
bsd            0.95  redistribution  redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd            0.9   redistributions  redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd            0.9   redistributions  redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause   0.93  endorse  neither the names? of (?:\\S+ ){1,12}may be used to endorse or promote products derived from this software
bsd-3-clause   0.9   endorse  the name of the author may not be used to endorse or promote products derived from this software
bsd-4-clause   0.93  advertising+mentioning  all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-0-clause   0.9   fee+hereby  permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
isc            0.93  fee+hereby  permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted provided that
mpl            0.97  mozilla  this source code form is subject to the terms of the mozilla public <lic> v 2 0
mpl            0.95  mozilla  the contents of this file are subject to the mozilla public <lic>(?: version)? 1 [01]
mpl            0.9   mpl  if a copy of the mpl was not distributed with this file you can obtain one at
epl            0.95  eclipse  this program and the accompanying materials are made available under the terms of the eclipse public <lic>
edl            0.9   eclipse  eclipse distribution <lic> v 1 0 which accompanies this distribution
cddl           0.95  development+distribution  the contents of this file are subject to the terms of the common development and distribution <lic>
osl            0.9   open+software  licensed under the open software <lic> version [123] [01]
afl            0.9   academic+free  licensed under the academic free <lic> version [123] [01]
perl           0.95  perl  you can redistribute it and or modify it under the same terms as perl(?: itself| 5)?
perl           0.9   perl  (?:under|on) the same terms as (?:the )?perl(?: itself| 5| programming language)?
artistic       0.9   artistic  the artistic <lic> preamble the intent of this document is to state the conditions
zlib           0.95  misrepresented  the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib           0.9   altered+misrepresented  altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng         0.9   png  the png reference library is supplied as is
boost          0.95  boost  distributed under the boost software <lic> version 1 0
boost          0.93  organization+accompanying  permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this <lic>
busl           0.9   change+anniversary  effective on the change date or the fourth anniversary of the first publicly available distribution
sspl           0.93  functionality+parties  if you make the functionality of the program or a modified version available to third parties as a service
elastic        0.93  hosted+managed  you may not provide the software to third parties as a hosted or managed service
unlicense      0.95  unencumbered  this is free and unencumbered software released into the public domain
unlicense      0.9   anyone+compile  anyone is free to copy modify publish use compile sell or distribute this software
wtfpl          0.95  fuck  do what the fuck you want to(?: public <lic>)?
python         0.93  psf  psf hereby grants licensee a nonexclusive royalty free world wide <lic>
python         0.9   cnri  cnri hereby grants licensee a nonexclusive royalty free world wide <lic>
php            0.93  php  this product includes php software freely available from
ruby           0.9   ruby|bsdl  you may (?:distribute|redistribute) it and or modify it under (?:either the terms of the 2 clause bsdl|the same terms as ruby)
openssl        0.95  openssl  this product includes software developed by the openssl project for use in the openssl toolkit
openssl        0.9   eric+cryptographic  this product includes cryptographic software written by eric young
ncsa           0.9   illinois  developed by (?:\\S+ ){1,12}university of illinois
postgresql     0.93  california+university  in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages
ofl            0.95  sil  this font software is licensed under the sil open font <lic>
ofl            0.9   font+hereby  permission is hereby granted free of charge to any person obtaining a copy of the font software
lppl           0.95  lppl|latex  this work may be distributed and or modified under the conditions of the latex project public <lic>
odbl           0.93  database+open  this (?:\\S+ ){0,6}database is made available under the open database <lic>
odc-by         0.93  attribution+commons  is made available under the open data commons attribution <lic>
pddl           0.93  dedication+domain  is made available under the public domain dedication and <lic>
cc0            0.95  waived  (?:has|have) waived all copyright and related or neighboring rights to
ms-pl          0.93  governs+accompanying  this <lic> governs use of the accompanying software if you use the software you accept this <lic>
apsl           0.93  apple  subject to the apple public source <lic>
w3c            0.93  royalty+hereby  permission to copy modify and distribute this (?:software|work) and its documentation with or without modification for any purpose and without fee or royalty is hereby granted
vim            0.9   vim  there are no restrictions on distributing unmodified copies of vim
upl            0.93  larger+contributed  (?:a|the) copy of the software and or to any larger works? to which the software is contributed
blueoak        0.93  permission+possible  this <lic> gives everyone as much permission to work with this software as possible
beerware       0.95  beer+retain  as long as you retain this notice you can do whatever you want with this stuff (?:\\S+ ){0,24}buy me a beer
json           0.95  evil+software  the software shall be used for good not evil
cecill         0.93  cecill  this software is governed by the cecill(?: [bc])? <lic> under french law
mulan          0.9   mulan+psl  you can use this software according to the terms and conditions of the mulan psl
openrail       0.93  restrictions+paragraph  use based restrictions as referenced in paragraph 5
llama          0.95  llama  is licensed under the llama [234](?: [0-9])? community <lic>
hippocratic    0.93  declaration+human  the software may not be used by (?:\\S+ ){1,12}universal declaration of human rights
"""

#: Places where licences are published.
PLACES = """
gpl            0.88  gnu  (?:www )?gnu org (?:licenses|copyleft)(?: old licenses)? gpl(?: [123] 0)?(?: html| txt| en html)?
lgpl           0.9   gnu  (?:www )?gnu org (?:licenses|copyleft)(?: old licenses)? lgpl(?: [23] [01])?(?: html| txt| en html)?
agpl           0.9   gnu  (?:www )?gnu org licenses agpl(?: 3 0)?(?: html| txt| en html)?
gfdl           0.9   gnu  (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 [123])?(?: html| txt)?
gpl            0.7   gnu  (?:see |see http |see https )?(?:www )?gnu org licenses(?: for)?
apache         0.92  apache  (?:www )?apache org licenses <lic> (?:1 [01]|2 0)(?: html| txt)?
apache         0.85  apache  (?:www )?apache org licenses
mit            0.9   opensource  (?:www )?opensource org licenses mit(?: <lic>)?(?: php| html)?
apache         0.9   opensource  (?:www )?opensource org licenses apache ?2(?: 0)?(?: php| html)?
bsd-2-clause   0.9   opensource  (?:www )?opensource org licenses bsd 2 clause
bsd-3-clause   0.9   opensource  (?:www )?opensource org licenses bsd 3 clause
bsd            0.88  opensource  (?:www )?opensource org licenses bsd <lic>(?: php| html)?
gpl            0.9   opensource  (?:www )?opensource org licenses gpl(?: <lic>| [23] 0)?(?: php| html)?
lgpl           0.9   opensource  (?:www )?opensource org licenses lgpl(?: <lic>| [23] [01])?(?: php| html)?
isc            0.9   opensource  (?:www )?opensource org licenses isc(?: <lic>)?(?: php| txt)?
zlib           0.9   opensource  (?:www )?opensource org licenses zlib(?: <lic>)?(?: php)?
osl            0.9   opensource  (?:www )?opensource org licenses osl [123] 0(?: php)?
afl            0.9   opensource  (?:www )?opensource org licenses afl [123] [01](?: php)?
ms-pl          0.9   opensource  (?:www )?opensource org licenses ms pl
mpl            0.92  mozilla  (?:www )?mozilla org (?:en us )?mpl(?: (?:1 [01]|2 0))?
epl            0.92  eclipse  (?:www )?eclipse org legal epl(?: v[12]0| [12] 0| v 2 0)?(?: html)?
edl            0.92  eclipse  (?:www )?eclipse org org documents edl v10
boost          0.92  boost  (?:www )?boost org <lic> 1 0(?: txt)?
unlicense      0.9   unlicense  (?:www )?unlicense org
wtfpl          0.9   wtfpl  (?:www |sam zoy org )?wtfpl (?:net|copying)
python         0.9   python  (?:www )?python org (?:psf )?<lic>
php            0.9   php  (?:www )?php net <lic>(?: 3 0[01]?)?(?: txt)?
ofl            0.92  sil  scripts sil org ofl
lppl           0.92  latex  (?:www )?latex project org lppl
odbl           0.92  opendatacommons  (?:www )?opendatacommons org licenses odbl(?: 1 0)?
odc-by         0.92  opendatacommons  (?:www )?opendatacommons org licenses by(?: 1 0)?
pddl           0.92  opendatacommons  (?:www )?opendatacommons org licenses pddl(?: 1 0)?
cc0            0.93  creativecommons  creativecommons org publicdomain zero 1 0
public-domain  0.85  creativecommons  creativecommons org publicdomain mark 1 0
cc-by-nc-nd    0.93  creativecommons  creativecommons org licenses by (?:nc nd|nd nc) [1234] [05]
cc-by-nc-sa    0.93  creativecommons  creativecommons org licenses by nc sa [1234] [05]
cc-by-nc       0.93  creativecommons  creativecommons org licenses by nc [1234] [05]
cc-by-nd       0.93  creativecommons  creativecommons org licenses by nd [1234] [05]
cc-by-sa       0.93  creativecommons  creativecommons org licenses by sa [1234] [05]
cc-by          0.93  creativecommons  creativecommons org licenses by [1234] [05]
eupl           0.9   eupl  (?:joinup ec europa eu|ec europa eu idabc) (?:\\S+ ){0,6}eupl
cecill         0.9   cecill  (?:www )?cecill info(?: licences)?
w3c            0.9   w3+consortium  (?:www )?w3 org consortium legal(?: \\d{4})? copyright software(?: \\d{8})?
sspl           0.9   mongodb  (?:www )?mongodb com licensing server side public <lic>
elastic        0.9   elastic  (?:www )?elastic co licensing elastic <lic>
curl           0.88  curl+copyright  curl (?:haxx )?se docs copyright
vim            0.85  vimdoc  vimdoc sourceforge net htmldoc uganda
"""

#: Licences by name, as grants, metadata and headings have them.
NAMES = """
gpl            0.95  gpl|gplv1|gplv2|gplv3|gpl1|gpl2|gpl3  <under>(?: gnu)? gpl(?:v?[123])?<v>[123](?: 0)?)?<later>(?: <lic>)?
gpl            0.95  general+public  <under>(?: gnu)? general public <lic><v>[123](?: 0)?)?<later>
gpl            0.9   gpl|gplv1|gplv2|gplv3|gpl1|gpl2|gpl3  <field>(?: gnu)? gpl(?:v?[123])?<v>[123](?: 0)?)?<later>
gpl            0.9   gnu  gnu general public <lic><v>[123](?: 0)?)<later>
gpl            0.85  gnu  gnu general public <lic>
gpl            0.9   gnu  gnu gpl(?:v[123])?<v>[123](?: 0)?)?<later>
gpl            0.9   gpl  gpl (?:version |v )?[123](?: 0)?(?: only| or later| or newer)
gpl            0.88  gpl  gpl (?:version [123]|v[123]|v [123]|[123] 0)
gpl            0.88  gplv1|gplv2|gplv3  gplv[123](?: only| or later)?
gpl            0.7   gpl  (?:the gpl <lic>|gpl licen[cs]ed|gpl compatible|under gpl|under the gpl)
gpl            0.85  classpath  gnu classpath exception|classpath exception to the gpl
lgpl           0.95  lgpl|lgplv2|lgplv3|lgpl2|lgpl3  <under>(?: gnu)? lgpl(?:v?[23])?<v>[23](?: [01])?)?(?: [01])?<later>(?: <lic>)?
lgpl           0.95  lesser  <under>(?: gnu)? lesser general public <lic><v>[23](?: [01])?)?<later>
lgpl           0.95  library+general  <under>(?: gnu)? library general public <lic><v>2(?: 0)?)?<later>
lgpl           0.9   lgpl|lgplv2|lgplv3  <field>(?: gnu)? lgpl(?:v[23])?<v>[23](?: [01])?)?<later>
lgpl           0.9   lesser  (?:gnu )?lesser general public <lic><v>[23](?: [01])?)?<later>
lgpl           0.88  library+gnu  gnu library general public <lic><v>2(?: 0)?)?<later>
lgpl           0.9   lgpl  (?:gnu )?lgpl (?:version [23](?: [01])?|v[23](?: [01])?|[23] [01])<later>
lgpl           0.88  lgplv2|lgplv3  lgplv[23](?: 1)?(?: only| or later)?
lgpl           0.85  lgpl  gnu lgpl|lgpl licen[cs]ed|under the lgpl
agpl           0.95  agpl|agplv3|agpl3  <under>(?: gnu)? agpl(?:v?3)?<v>[13](?: 0)?)?<later>(?: <lic>)?
agpl           0.95  affero  <under>(?: gnu)? affero general public <lic><v>[13](?: 0)?)?<later>
agpl           0.9   agpl|agplv3  <field>(?: gnu)? agpl(?:v3)?<v>[13](?: 0)?)?<later>
agpl           0.9   affero  (?:gnu )?affero general public <lic><v>[13](?: 0)?)?<later>
agpl           0.9   agpl  (?:gnu )?agpl (?:version 3|v3|3 0)<later>
agpl           0.88  agplv3  agplv3(?: only| or later)?
gfdl           0.95  documentation+free  <under>(?: gnu)? free documentation <lic><v>1 [123])?<later>
gfdl           0.9   documentation+gnu  gnu free documentation <lic><v>1 [123])?<later>
gfdl           0.9   gfdl  gfdl(?: 1 [123])?(?: or later)?
apache         0.95  apache|apache2  <under> apache2?(?: software)?(?: foundation)?(?: <lic>)?<v>(?:1 [01]|2(?: 0)?))?(?: <lic>)?
apache         0.9   apache|apache2  <field> apache2?(?: software)?(?: <lic>)?<v>(?:1 [01]|2(?: 0)?))?
apache         0.9   apache  apache(?: software)? <lic><v>(?:1 [01]|2(?: 0)?))
apache         0.8   apache  apache(?: software)? <lic>
apache         0.85  apache  apache (?:2 0|version 2(?: 0)?|v2(?: 0)?)(?: <lic>)?
apache         0.85  asl  <field> asl(?: 2 0)?|<under> asl(?: 2 0)?
mit            0.95  mit  <under> mit(?: expat| x11| style| like)?(?: <lic>)?
mit            0.9   mit  <field> mit(?: expat| x11)?
mit            0.8   mit  (?:the )?mit(?: expat| x11)? <lic>
mit            0.85  mit  mit (?:style|type) <lic>
mit            0.9   mit  dual licensed(?: under)?(?: the)? mit
mit            0.9   mit+apache  mit(?= (?:or |and )?apache (?:<lic> )?(?:version )?v?2 )
mit            0.88  expat  (?:the )?expat <lic>|<under>(?: the)? expat(?: <lic>)?
mit            0.85  mit  mit 0|mit no attribution
x11            0.85  x11  (?:the )?x11 <lic>|<under>(?: the)? x11(?: <lic>)?
bsd-3-clause   0.95  bsd  <under>(?: the)? (?:new|modified|revised|3 clause|three clause) bsd(?: <lic>)?
bsd-3-clause   0.93  bsd  bsd (?:3|three) clause(?: clear| <lic>)?
bsd-3-clause   0.9   bsd  (?:new|modified|revised|3 clause|three clause) bsd(?: style)? <lic>
bsd-2-clause   0.95  bsd  <under>(?: the)? (?:simplified|2 clause|two clause) bsd(?: <lic>)?
bsd-2-clause   0.93  bsd  bsd (?:2|two) clause(?: <lic>)?
bsd-2-clause   0.9   bsd|freebsd  (?:simplified bsd|2 clause bsd|two clause bsd|free ?bsd) <lic>
bsd-4-clause   0.93  bsd  bsd (?:4|four) clause(?: <lic>)?
bsd-4-clause   0.9   bsd  (?:original|old|4 clause|four clause) bsd <lic>
bsd-1-clause   0.9   bsd  bsd (?:1|one) clause(?: <lic>)?
bsd-0-clause   0.9   0bsd  0bsd(?: <lic>)?|<under>(?: the)? 0bsd
bsd-0-clause   0.9   bsd  (?:zero|0) clause bsd(?: <lic>)?
bsd            0.93  bsd  <under>(?: the)? bsd(?: style| like)?(?: <lic>)?
bsd            0.88  bsd  <field> bsd(?: style| like)?
bsd            0.85  bsd  bsd(?: style| like| type)? <lic>
bsd            0.8   berkeley+software  berkeley software distribution <lic>
isc            0.93  isc  <under>(?: the)? isc(?: <lic>)?
isc            0.85  isc  <field> isc|(?:the )?isc <lic>|isc style <lic>
isc            0.85  internet+consortium  internet (?:systems|software) consortium <lic>
mpl            0.95  mozilla  <under>(?: the)? mozilla public <lic><v>(?:1 [01]|2(?: 0)?))?
mpl            0.9   mozilla  mozilla public <lic><v>(?:1 [01]|2(?: 0)?))?
mpl            0.95  mpl|mplv2|mpl2  <under>(?: the)? mpl(?:v?2)?<v>(?:1 [01]|2(?: 0)?))?(?: 0)?
mpl            0.9   mpl|mplv2|mpl2  <field> mpl(?:v?2)?<v>(?:1 [01]|2(?: 0)?))?
mpl            0.85  mpl  mpl (?:1 [01]|2 0|version 2)
epl            0.95  eclipse  <under>(?: the)? eclipse public <lic><v>[12](?: 0)?)?
epl            0.9   eclipse  eclipse public <lic><v>[12](?: 0)?)?
epl            0.93  epl|eplv2  <under>(?: the)? epl(?:v2)?<v>[12](?: 0)?)?
epl            0.88  epl|eplv2  <field> epl(?:v2)?<v>[12](?: 0)?)?|epl [12] 0
edl            0.9   eclipse  eclipse distribution <lic><v>1(?: 0)?)?
eupl           0.93  european+union  european union public licen[cs]e<v>1(?: [012])?)?
eupl           0.93  eupl  <under>(?: the)? eupl<v>1(?: [012])?)?
eupl           0.88  eupl  <field> eupl<v>1(?: [012])?)?|eupl 1 [012]
cddl           0.93  distribution+common  common development and distribution <lic><v>1(?: [01])?)?
cddl           0.93  cddl  <under>(?: the)? cddl<v>1(?: [01])?)?
cddl           0.88  cddl  <field> cddl<v>1(?: [01])?)?|cddl 1 [01]|cddl <lic>
cpl            0.9   common+public  common public <lic><v>1(?: 0)?)?
cpl            0.88  cpl  <under>(?: the)? cpl(?: 1 0)?|cpl 1 0
ipl            0.9   ibm  ibm public <lic><v>1(?: 0)?)?
osl            0.93  open+software  open software <lic><v>[123](?: 0)?)?
osl            0.88  osl  <under>(?: the)? osl(?: [123] 0)?|osl [123] 0
afl            0.93  academic+free  academic free <lic><v>[123](?: [01])?)?
afl            0.88  afl  <under>(?: the)? afl(?: [123] [01])?|afl [123] [01]
artistic       0.93  artistic  <under>(?: the)?(?: perl)? artistic(?: <lic>)?<v>[12](?: 0)?)?
artistic       0.9   artistic  (?:perl )?artistic <lic><v>[12](?: 0)?)?
artistic       0.85  artistic  <field> artistic(?: [12] 0)?
perl           0.88  perl  <field> perl(?: 5)?
zlib           0.9   zlib  <under>(?: the)? zlib(?: libpng)?(?: <lic>)?
zlib           0.88  zlib  (?:the )?zlib(?: libpng)? <lic>|<field> zlib
libpng         0.88  libpng  (?:the )?libpng <lic>(?: version 2)?|<under>(?: the)? libpng(?: <lic>)?
boost          0.93  boost  boost software <lic><v>1(?: 0)?)?
boost          0.88  boost  <under>(?: the)? boost(?: <lic>)?|<field> boost(?: 1 0)?
busl           0.93  business+source  business source <lic><v>1(?: [01])?)?
busl           0.88  busl  <under>(?: the)? busl(?: 1 1)?|busl 1 1
sspl           0.93  server+side  server side public <lic><v>1)?
sspl           0.88  sspl|ssplv1  <under>(?: the)? sspl(?:v1)?|<field> sspl(?:v1)?|sspl <lic>
elastic        0.93  elastic  elastic <lic><v>2(?: 0)?)
elastic        0.9   elastic  <under>(?: the)? elastic <lic><v>2(?: 0)?)?
unlicense      0.93  unlicense  <under>(?: the)? unlicense|<field>(?: the)? unlicense|the unlicense
wtfpl          0.93  wtfpl  <under>(?: the)? wtfpl(?: 2)?|<field> wtfpl|wtfpl (?:<lic>|version 2|2 0)
python         0.93  python  python software foundation <lic><v>2(?: 0)?)?
python         0.9   psf|python  <under>(?: the)? (?:psf|python)(?: <lic>)(?: version 2)?
python         0.88  psf  (?:the )?psf <lic>(?: version 2)?|<field> psf(?: 2 0)?
php            0.9   php  <under>(?: the)? php <lic><v>3(?: 0[01]?)?)?|php <lic><v>3(?: 0[01]?)?)
ruby           0.88  ruby  <under>(?: the)? ruby(?: s)? <lic>|the ruby <lic>
openssl        0.9   openssl  <under>(?: the)? openssl <lic>|openssl (?:ssleay )?<lic>
openssl        0.85  ssleay  (?:original )?ssleay <lic>
curl           0.85  curl  <under>(?: the)? curl <lic>|the curl <lic>
ncsa           0.9   illinois  university of illinois (?:ncsa )?open source <lic>
ncsa           0.85  ncsa  <under>(?: the)? ncsa(?: open source)? <lic>|<field> ncsa
postgresql     0.9   postgresql  <under>(?: the)? postgresql <lic>|(?:the )?postgresql <lic>
ofl            0.93  font+open  (?:sil )?open font <lic><v>1(?: [01])?)?
ofl            0.9   ofl  (?:sil )?ofl (?:version )?1 [01]|sil ofl|<under>(?: the)? ofl
lppl           0.93  latex  latex project public <lic><v>1(?: [0-9][ac]?)?)?
lppl           0.88  lppl  <under>(?: the)? lppl(?: 1 [0-9][ac]?)?|lppl 1 [0-9][ac]?
odbl           0.93  database+open  open (?:data commons open )?database <lic><v>1(?: 0)?)?
odbl           0.88  odbl  <under>(?: the)? odbl(?: 1 0)?|<field> odbl|odbl 1 0
odc-by         0.93  commons+attribution  open data commons attribution <lic><v>1(?: 0)?)?
odc-by         0.88  odc  odc by(?: 1 0)?
pddl           0.93  dedication+domain  public domain dedication and <lic>(?: 1 0)?
pddl           0.88  pddl  <under>(?: the)? pddl|pddl 1 0
cc0            0.93  cc0  (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc0            0.93  zero+creative  creative commons zero(?: 1 0| <lic>| v1 0 universal)?
cc-by-nc-nd    0.93  cc  cc by (?:nc nd|nd nc)(?: [1234](?: [05])?)?
cc-by-nc-sa    0.93  cc  cc by (?:nc sa|sa nc)(?: [1234](?: [05])?)?
cc-by-nc       0.93  cc  cc by nc(?: [1234](?: [05])?)?
cc-by-nd       0.93  cc  cc by nd(?: [1234](?: [05])?)?
cc-by-sa       0.93  cc  cc by sa(?: [1234](?: [05])?)?
cc-by          0.9   cc  cc by(?: [1234](?: [05])?)?(?: <lic>)?
cc-by-nc-nd    0.95  creative  creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-nc-sa    0.95  creative  creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc       0.95  creative  creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nd       0.95  creative  creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-sa       0.95  creative  creative commons attribution share ?alike(?: [1234] [05])?
cc-by          0.93  creative  creative commons attribution(?: [1234] [05])?(?: (?:international|unported|generic))?(?: <lic>)?
cc             0.7   creative  creative commons <lic>|<under>(?: a| the)? creative commons
ms-pl          0.93  microsoft  microsoft public <lic>
ms-pl          0.88  ms  <under>(?: the)? ms pl|<field> ms pl|ms pl <lic>
ms-rl          0.93  microsoft  microsoft reciprocal <lic>
ms-rl          0.88  ms  <under>(?: the)? ms rl|<field> ms rl
apsl           0.93  apple  apple public source <lic><v>[12](?: [012])?)?
apsl           0.88  apsl  <under>(?: the)? apsl(?: [12] [012])?|apsl [12] [012]
intel          0.9   intel  intel open source <lic>
nasa           0.9   nasa|nosa  nasa open source agreement<v>1(?: 3)?)?|<under>(?: the)? nosa
qpl            0.9   q+public  q public <lic><v>1(?: 0)?)?
qpl            0.85  qpl  <under>(?: the)? qpl|qpl 1 0
sleepycat      0.9   sleepycat  (?:the )?sleepycat <lic>|<under>(?: the)? sleepycat(?: <lic>)?
w3c            0.9   w3c  w3c software(?: notice)?(?: and document)?(?: and)? <lic>|w3c <lic>
vim            0.85  vim  <under>(?: the)? vim <lic>|the vim <lic>
upl            0.93  universal+permissive  universal permissive <lic><v>1(?: 0)?)?
upl            0.88  upl  <under>(?: the)? upl(?: 1 0)?|upl 1 0
blueoak        0.93  oak+blue  blue oak model <lic>(?: 1 0 0)?
ecl            0.93  educational+community  educational community <lic><v>[12](?: 0)?)?
mulan          0.93  mulan  mulan (?:psl|permissive software <lic>|public <lic>)(?: v?[12])?
cecill         0.9   cecill  (?:the )?cecill(?: [bc])?(?: [12] [01])? <lic>|<under>(?: the)? cecill(?: [bc])?
llama          0.93  llama+community  llama(?: [234](?: [0-9])?)? community <lic>
gemma          0.9   gemma  gemma terms of use
openrail       0.93  openrail|rail  (?:bigscience |creativeml |bigcode )?open ?rail(?: m)?(?: <lic>)?
hippocratic    0.93  hippocratic  hippocratic <lic><v>[123](?: [01])?)?
json           0.9   json  (?:the|<under>(?: the)?) json <lic>
beerware       0.9   beerware|beer  (?:the )?beer ?ware <lic>
commons-clause 0.9   commons+clause  commons clause(?: <lic>)? (?:<lic> )?condition(?: v1 0| 1 0)?
polyform       0.9   polyform  polyform (?:noncommercial|small business|shield|strict|perimeter)(?: <lic>)?(?: 1 0 0)?
fair-source    0.85  functional+source|fair+source  (?:functional|fair) source <lic>(?: 0 9| 1 [01])?
eiffel         0.88  eiffel  eiffel forum <lic>(?: version [12])?
zope           0.9   zope  zope public <lic><v>[12](?: [01])?)?
sun            0.88  sun+source|sun+public  sun public <lic>(?: version 1 0)?|sun industry standards source <lic>
netscape       0.9   netscape  netscape public <lic><v>1(?: [01])?)?
realnetworks   0.88  realnetworks  realnetworks public source <lic>
jython         0.85  jython  jython <lic>
latex2e        0.85  latex2e  latex2e <lic>
ijg            0.9   ijg|jpeg+independent  independent jpeg group(?: s)? <lic>|<under>(?: the)? ijg <lic>
freetype       0.9   freetype  (?:the )?freetype(?: project)? <lic>
imagemagick    0.9   imagemagick  (?:the )?imagemagick <lic>
icu            0.85  icu  (?:the )?icu <lic>
unicode        0.9   unicode  unicode <lic> (?:agreement|v3)|unicode inc <lic> agreement
tcl            0.85  tcl  (?:the )?tcl(?: tk)? <lic>
xfree86        0.88  xfree86  xfree86 <lic>(?: 1 1)?
dco            0.6   developer+certificate  developer certificate of origin(?: version 1 1)?
cla            0.6   contributor+agreement  contributor <lic> agreement
"""

#: Notices that keep rights or give them up without naming a licence.
NOTICES = """
public-domain        0.8   domain+public  (?:dedicated to|released into|placed in(?:to)?|donated to) the public domain
public-domain        0.7   domain+public  (?:is|are) in the public domain|public domain (?:work|software|dedication|mark)
all-rights-reserved  0.6   reserved+rights  all rights reserved
all-rights-reserved  0.6   rechte  alle rechte vorbehalten
all-rights-reserved  0.6   droits  tous droits réservés
all-rights-reserved  0.6   derechos  todos los derechos reservados
proprietary          0.8   proprietary  proprietary and confidential|confidential and proprietary
proprietary          0.75  proprietary  proprietary (?:<lic>|software|information|rights notice)
proprietary          0.75  unauthorized+this  unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|program|work|document)
proprietary          0.7   reproduced+part  no part of this (?:publication|book|work|document|file) may be reproduced
proprietary          0.7   permission+written|consent+written  without the (?:prior |express )*written (?:permission|consent) of
proprietary          0.75  eula  end user <lic> agreement eula|the eula
proprietary          0.75  agreement+user  end user <lic> agreement
non-commercial       0.7   commercial+only|noncommercial+only  for non ?commercial (?:use|purposes) only
non-commercial       0.65  research+only  for research (?:use|purposes) only
no-derivatives       0.6   derivative+works  no derivative works
attribution          0.6   attribution+with|attribution+requires  (?:with|requires) (?:proper |appropriate )?attribution(?: required)?
fair-use             0.5   fair+use  fair use (?:notice|doctrine)
"""


def signatures() -> list[tuple[str, float, str, str]]:
    """(label, certainty, keywords, pattern) of every signature, in the order of priority."""
    out = []
    for lines in (TAGS, TEXTS, PLACES, NAMES, NOTICES):
        for line in lines.strip().splitlines():
            label, certainty, keywords, pattern = line.split(None, 3)
            for name, part in PARTS.items():
                pattern = pattern.replace(name, part)
            out.append((label, float(certainty), keywords, pattern))
    return out
