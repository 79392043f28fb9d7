"""Signature rules for licences, in the order in which they are tried.

A line is: label | keyword | pattern. The keyword must stand in the text for the pattern to be tried at all. Patterns are
regular expressions over lower-case words: a space stands for whatever separates two words, LIC for either
spelling of licence, V for a version with or without its prefix, and `..` for up to eight words between.
"""

#: Whole sentences of licence texts and notices: they say most, and what they contain is suppressed.
TEXTS = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies
isc | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee
0bsd | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
hpnd | permission to use copy | permission to use copy modify and distribute this software and its documentation for any purpose
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse or promote | neither the names? .. may be used to endorse or promote products
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display
apache | licensed under the apache | licensed under the apache LIC version [12] [01]
apache | you may not use this file | you may not use this file except in compliance with the LIC
gpl | free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public LIC
gpl | free software | this is free software and you are welcome to redistribute it
lgpl | free software | this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public LIC
agpl | affero | under the terms of the gnu affero general public LIC
gpl | under the terms of the gnu | under the terms of the gnu general public LIC
lgpl | under the terms of the gnu | under the terms of the gnu (lesser|library) general public LIC
gfdl | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation LIC
gpl | without even the implied | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public LIC
mpl | mozilla | this source code form is subject to the terms of the mozilla public LIC
mpl | mozilla | the contents of this file are subject to the mozilla public LIC
npl | netscape | the contents of this file are subject to the netscape public LIC
epl | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public LIC
cpl | common public | made available under the terms of the common public LIC
cddl | common development and | the contents of this file are subject to the terms of the common development and distribution LIC
eupl | eupl | licensed under the eupl
eupl | european union public | licensed under the european union public licen[cs]e
osl | open software licen | licensed under the open software LIC
afl | academic free licen | licensed under the academic free LIC
apsl | apple public source | subject to the apple public source LIC
boost | boost software | distributed under the boost software LIC
zlib | altered source versions | altered source versions must be plainly marked as such
zlib | this software is provided | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy | anyone is free to copy modify publish use compile sell or distribute this software
public-domain | public domain | (released|placed|dedicated|put|donated) (in|into|to) the public domain
public-domain | public domain | (is|are) (hereby )?in the public domain
public-domain | public domain | no copyright .. public domain
cc0 | affirmer | affirmer hereby overtly fully permanently irrevocably and unconditionally waives
cc0 | waived all copyright | to the extent possible under law .. waived all copyright and related
wtfpl | you just do what | you just do what the fuck you want to
beerware | buy me a beer | you think this stuff is worth it you can buy me a beer
ofl | reserved font name | (with )?reserved font name
ofl | this font software | this font software is licensed under the sil open font LIC
json | for good not evil | the software shall be used for good not evil
openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | eric young | this product includes cryptographic software written by eric young
curl | copyright | copyright .. daniel stenberg
libpng | libpng | this copy of the libpng notices is provided for your convenience
ijg | independent jpeg | this software is based in part on the work of the independent jpeg group
freetype | freetype | portions of this software are copyright .. the freetype project
unicode | unicode | this file is provided as is by unicode inc
php | includes php | this product includes php software
ncsa | deal with the software | to deal with the software without restriction
postgresql | without a written agreement | for any purpose without fee and without a written agreement is hereby granted
proprietary | proprietary | (this|the following) .. (confidential and proprietary|proprietary and confidential)
proprietary | strictly prohibited | unauthori[sz]ed copying of this .. is strictly prohibited
proprietary | prior written | (reproduced|distributed|transmitted) .. without (the )?(express )?prior written (permission|consent)
proprietary | without permission | (may not|must not) be (reproduced|copied|redistributed) .. without permission
cc-by | creative commons | (licensed|released|distributed|available) under .. creative commons attribution LIC
cc-by | creative commons | (licensed|released|distributed|available) under .. creative commons attribution [1-4] [0-9]
cc-by-sa | creative commons | (licensed|released|distributed|available) under .. creative commons attribution share ?alike
cc-by-nc | creative commons | (licensed|released|distributed|available) under .. creative commons attribution non ?commercial
cc-by-nd | creative commons | (licensed|released|distributed|available) under .. creative commons attribution no ?deriv(ative)?s?
"""

#: Names with a version or variant: what they contain of a shorter name is suppressed.
VARIANTS = r"""
agpl-3 | affero | gnu affero general public LIC V 3
agpl | affero | (gnu )?affero general public LIC
lgpl-2 | lesser | (gnu )?lesser general public LIC V 2( 1| 0)?
lgpl-3 | lesser | (gnu )?lesser general public LIC V 3
lgpl-2 | library general | (gnu )?library general public LIC V 2
gpl-2 | general public | (gnu )?general public LIC V 2
gpl-3 | general public | (gnu )?general public LIC V 3
gpl-1 | general public | (gnu )?general public LIC V 1
gpl-2 | gpl | (gnu )?gpl ?V 2( 0)?( or later| only)?
gpl-3 | gpl | (gnu )?gpl ?V 3( 0)?( or later| only)?
lgpl-2 | lgpl | (gnu )?lgpl ?V 2( 1| 0)?( or later| only)?
lgpl-3 | lgpl | (gnu )?lgpl ?V 3( 0)?( or later| only)?
agpl-3 | agpl | (gnu )?agpl ?V 3( 0)?( or later| only)?
gpl-exception | exception | (gnu )?general public LIC .. with .. (classpath|linking|runtime library) exception
gpl-exception | classpath exception | (gpl|with)( V 2)? with( the)? classpath exception
gfdl | free documentation | gnu free documentation LIC( V 1)?
apache-1.0 | apache | apache( software)? LIC V 1 0
apache-1.1 | apache | apache( software)? LIC V 1 1
apache-2.0 | apache | apache( software)? LIC V 2( 0)?
apache-2.0 | apache | apache ?V 2( 0)?
bsd-2-clause | bsd | (bsd 2|2|two) clause bsd( LIC)?
bsd-2-clause | bsd | bsd (2|two) clause( LIC)?
bsd-3-clause | bsd | (3|three) clause bsd( LIC)?
bsd-3-clause | bsd | bsd (3|three) clause( LIC)?
bsd-4-clause | bsd | (4|four) clause bsd( LIC)?
bsd-4-clause | bsd | bsd (4|four) clause( LIC)?
bsd-3-clause | bsd | (new|modified|revised) bsd LIC
bsd-2-clause | bsd | (simplified|freebsd) bsd LIC
bsd-4-clause | bsd | (original|old) bsd LIC
0bsd | bsd | (zero clause bsd|bsd zero clause|free public) LIC
mpl-1.1 | mozilla | mozilla public LIC V 1 [01]
mpl-2.0 | mozilla | mozilla public LIC V 2( 0)?
epl-1.0 | eclipse | eclipse public LIC V 1( 0)?
epl-2.0 | eclipse | eclipse public LIC V 2( 0)?
eupl | european union public | european union public LIC V 1 [0-2]
artistic-1.0 | artistic | artistic LIC V 1( 0)?
artistic-2.0 | artistic | artistic LIC V 2( 0)?
osl-3.0 | open software licen | open software LIC V 3( 0)?
afl-3.0 | academic free licen | academic free LIC V [1-3] [01]
boost | boost software | boost software LIC V 1( 0)?
cc0 | cc0 | cc0 1 0( universal)?
cc0 | creative commons zero | creative commons zero( V 1 0)?( universal)?
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike( LIC)?( V [1-4] [0-9])?
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(ative)?s?( LIC)?( V [1-4] [0-9])?
cc-by-nc | creative commons | creative commons attribution non ?commercial( LIC)?( V [1-4] [0-9])?
cc-by-nd | creative commons | creative commons attribution no ?deriv(ative)?s?( LIC)?( V [1-4] [0-9])?
cc-by-sa | creative commons | creative commons attribution share ?alike( LIC)?( V [1-4] [0-9])?
cc-by-nc-sa | cc | cc by nc sa( [1-4] [0-9])?( international| unported)?
cc-by-nc-nd | cc | cc by nc nd( [1-4] [0-9])?( international| unported)?
cc-by-nc | cc | cc by nc( [1-4] [0-9])?( international| unported)?
cc-by-nd | cc | cc by nd( [1-4] [0-9])?( international| unported)?
cc-by-sa | cc | cc by sa( [1-4] [0-9])?( international| unported)?
cc-by-4.0 | cc | cc by 4 0( international)?
cc-by-3.0 | cc | cc by 3 0( unported| us| igo)?
cc-by-2.5 | cc | cc by 2 [05]
ofl | open font | (sil )?open font LIC V 1( 1| 0)?
odbl | open database | open database LIC V 1 0
python-2.0 | python | python( software foundation)? LIC V 2( 0)?
zpl | zope | zope public LIC V [12] [01]
lppl | latex project | latex project public LIC V 1 3
cecill | cecill | cecill V [12]( [01])?
mulan-psl | mulan | mulan (permissive software LIC|psl) V [12]
sspl | server side public | server side public LIC V 1
busl | business source | business source LIC V 1 1
elastic | elastic | elastic LIC V 2( 0)?
openrail | openrail | (creative ml |bigscience )?openrail( m)?( LIC)?
bigscience | bigscience | bigscience (rail|bloom rail) LIC
"""

#: Plain names.
NAMES = r"""
gpl | general public | gnu general public LIC
gpl | gpl | (gnu|the) gpl
lgpl | lesser | (gnu )?lesser general public LIC
lgpl | library general | (gnu )?library general public LIC
lgpl | lgpl | (gnu|the) lgpl
agpl | agpl | (gnu|the) agpl
gfdl | gfdl | (gnu|the) gfdl
apache | apache | apache( software)?( foundation)? LIC
apache | asl 2 | asl 2 0
mit | mit | mit( x11| expat)? LIC
mit | expat | expat LIC
mit | massachusetts | massachusetts institute of technology LIC
x11 | x11 | x11 LIC
bsd | bsd | bsd( style)? LIC
bsd | berkeley | berkeley software distribution LIC
isc | isc | isc LIC
isc | internet software | internet software consortium LIC
mpl | mozilla | mozilla public LIC
mpl | mpl | (the )?mpl V [12] [01]
npl | netscape | netscape public LIC
epl | eclipse | eclipse public LIC
edl | eclipse | eclipse distribution LIC
cpl | common public | common public LIC
cpal | common public attribution | common public attribution LIC
cddl | common development and | common development and distribution LIC
cddl | cddl | cddl( V 1 [01])?
ipl | ibm public | ibm public LIC
eupl | european union public | european union public LIC
osl | open software licen | open software LIC
afl | academic free licen | academic free LIC
ecl | educational community | educational community LIC
apsl | apple public source | apple public source LIC
artistic | artistic | (perl |clarified )?artistic LIC
perl | perl | same terms as perl( itself)?
boost | boost software | boost software LIC
zlib | zlib | zlib( libpng)? LIC
libpng | libpng | libpng LIC
unlicense | unlicense | (the )?unlicense
wtfpl | wtfpl | wtfpl
wtfpl | public licen | do what the fuck you want to public LIC
beerware | beer | beer ?ware LIC
ofl | open font | (sil )?open font LIC
odbl | open database | (open data commons )?open database LIC
odc-by | open data commons | open data commons attribution LIC
pddl | public domain dedication | public domain dedication and LIC
cc0 | cc0 | (creative commons )?cc0
cc-by | cc | cc by
cc-by | creative commons | creative commons( public)? LIC
cc-by | creative commons | creative commons attribution
public-domain | public domain | public domain (work|software|mark|notice|dedication)
python | python | python( software foundation)? LIC
python | psf | psf LIC
php | php | php LIC
ruby | ruby | ruby LIC
openssl | openssl | openssl LIC
ssleay | ssleay | ssleay LIC
curl | curl | curl LIC
ijg | ijg | ijg LIC
freetype | freetype | freetype( project)? LIC
ncsa | ncsa | (university of illinois )?ncsa( open source)? LIC
postgresql | postgresql | postgresql LIC
w3c | w3c | w3c (software|document)( notice)?( and)? LIC
unicode | unicode | unicode( terms of use| LIC)( agreement)?
icu | icu | icu LIC
json | json | json LIC
vim | vim | vim LIC
tcl | tcl | tcl( tk)? LIC
zpl | zope | zope public LIC
hpnd | historical permission | historical permission notice and disclaimer
cecill | cecill | cecill( b| c)?( LIC)?
lppl | latex project | latex project public LIC
lppl | lppl | lppl( 1 3)?
qpl | q public | q public LIC
rpl | reciprocal public | reciprocal public LIC
sissl | sun industry | sun industry standards source LIC
sleepycat | sleepycat | sleepycat LIC
spl | sun public | sun public LIC
watcom | watcom | sybase open watcom public LIC
ms-pl | microsoft | microsoft public LIC
ms-rl | microsoft | microsoft reciprocal LIC
ms-pl | ms pl | ms pl
nasa | nasa open source | nasa open source agreement
nokia | nokia | nokia open source LIC
intel | intel | intel open source LIC
ntp | ntp | ntp LIC
openldap | openldap | openldap public LIC
oclc | oclc | oclc research public LIC
fair | fair | fair( source)? LIC
miros | miros | miros LIC
naumen | naumen | naumen public LIC
motosoto | motosoto | motosoto LIC
jabber | jabber | jabber open source LIC
ricoh | ricoh | ricoh source code public LIC
vovida | vovida | vovida software LIC
entessa | entessa | entessa public LIC
lucent | lucent | lucent public LIC
frameworx | frameworx | frameworx( open)? LIC
eiffel | eiffel | eiffel forum LIC
bitstream | bitstream | bitstream vera( fonts?)? (copyright|LIC)
ubuntu-font | ubuntu font | ubuntu font LIC
mulan-psl | mulan | mulan (permissive software LIC|psl)
sspl | server side public | server side public LIC
busl | business source | business source LIC
elastic | elastic | elastic LIC
commons-clause | commons clause | commons clause( LIC)?( condition)?
polyform | polyform | polyform (noncommercial|strict|small business|shield|perimeter|free trial|internal use)( LIC)?
confluent | confluent | confluent community LIC
redis | redis | redis source available LIC
timescale | timescale | timescale LIC
llama | llama | (meta )?llama ?[2-4]?( [0-9])? community LIC
gemma | gemma | gemma terms of use
openai | openai | openai terms of use
ogl | open government | open government LIC
etalab | etalab | (etalab )?(open )?LIC( ouverte)? etalab
cdla | community data | community data LIC agreement
proprietary | proprietary | proprietary( software)? LIC
proprietary | end user | end user LIC agreement
proprietary | commercial licen | commercial LIC( agreement)?
"""

#: Places on the web and short tags.
TAGS = r"""
gpl | gnu org | gnu org licenses (old licenses )?gpl
lgpl | gnu org | gnu org licenses (old licenses )?lgpl
agpl | gnu org | gnu org licenses agpl
gfdl | gnu org | gnu org licenses (old licenses )?fdl
apache-2.0 | apache org | apache org licenses license 2 0
mit | opensource org | opensource org licenses? mit
bsd | opensource org | opensource org licenses? bsd
isc | opensource org | opensource org licenses? isc
artistic | opensource org | opensource org licenses? artistic
mpl | mozilla org | mozilla org mpl
epl | eclipse org | eclipse org (legal|org documents) epl
boost | boost org | boost org license 1 0
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | wtfpl net
ofl | scripts sil org | scripts sil org ofl
cc0 | creativecommons org | creativecommons org publicdomain zero
public-domain | creativecommons org | creativecommons org publicdomain mark
cc-by-nc-sa | creativecommons org | creativecommons org licenses by nc sa
cc-by-nc-nd | creativecommons org | creativecommons org licenses by nc nd
cc-by-nc | creativecommons org | creativecommons org licenses by nc
cc-by-nd | creativecommons org | creativecommons org licenses by nd
cc-by-sa | creativecommons org | creativecommons org licenses by sa
cc-by | creativecommons org | creativecommons org licenses by
odbl | opendatacommons org | opendatacommons org licenses odbl
all-rights-reserved | rights reserved | all rights reserved
copyright | copyright | copyright( c)? (19|20)[0-9][0-9]
copyright | \xc2\xa9 | \xc2\xa9 ?(19|20)[0-9][0-9]
"""

#: Identifiers of software package data exchange, as their words: `spdx license identifier` and the id.
IDENTIFIERS = """
0bsd afl-1.1 afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-1.0 apsl-2.0 artistic-1.0 artistic-2.0 beerware bsd-1-clause bsd-2-clause bsd-3-clause
bsd-4-clause bsl-1.0 busl-1.1 cc0-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0
cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0 cddl-1.0 cddl-1.1 cecill-2.1 cpal-1.0 cpl-1.0 curl ecl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2
fsfap ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-3.0 hpnd icu ijg ipl-1.0 isc json lgpl-2.0 lgpl-2.1 lgpl-3.0 libpng lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa
ntp odbl-1.0 odc-by-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sissl sleepycat sspl-1.0 tcl unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
"""
