"""Hand-written signatures of license texts, headers and notices.

Each is a label, an expression over lower-case words joined by blanks, and gate
words, one of which every match holds. The wording of licenses is fixed; where
published copies differ, the expression allows both.
"""

from __future__ import annotations

# A sentence that names its license for certain, and ones that name a family (fixed values).
SENTENCES: tuple[tuple[str, str, str], ...] = (
    # GNU licenses: heads, preambles, notices.
    ("gpl-1.0", "gnu general public licen[cs]e version 1 february 1989", "gnu"),
    ("gpl-2.0", "gnu general public licen[cs]e version 2 june 1991", "gnu"),
    ("gpl-3.0", "gnu general public licen[cs]e version 3 29 june 2007", "gnu"),
    ("lgpl-2.0", "gnu library general public licen[cs]e version 2 june 1991", "library"),
    ("lgpl-2.1", "gnu lesser general public licen[cs]e version 2 1 february 1999", "lesser"),
    ("lgpl-3.0", "gnu lesser general public licen[cs]e version 3 29 june 2007", "lesser"),
    ("agpl-1.0", "affero general public licen[cs]e version 1 march 2002", "affero"),
    ("agpl-3.0", "gnu affero general public licen[cs]e version 3 19 november 2007", "affero"),
    ("gfdl-1.1", "gnu free documentation licen[cs]e version 1 1 march 2000", "documentation"),
    ("gfdl-1.2", "gnu free documentation licen[cs]e version 1 2 november 2002", "documentation"),
    ("gfdl-1.3", "gnu free documentation licen[cs]e version 1 3 3 november 2008", "documentation"),
    ("gpl-2.0", "the licen[cs]es for most software are designed to take away your freedom to share and change it", "freedom"),
    ("gpl-3.0", "the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works", "copyleft"),
    ("agpl-3.0", "the gnu affero general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works",
     "copyleft"),
    ("agpl-3.0", "your modified version must prominently offer all users interacting with it remotely through a computer network",
     "remotely"),
    ("lgpl-2.1", "this is the first released version of the lesser gpl it also counts as the successor of the gnu library public "
     "licen[cs]e", "successor"),
    ("lgpl-2.0", "this is the first released version of the library gpl it is numbered 2 because it goes with version 2 of the "
     "ordinary gpl", "numbered"),
    ("lgpl-3.0", "this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3",
     "incorporates"),
    ("gpl-2.0-or-later", "gnu general public licen[cs]e as published by the free software foundation either version 2 of the "
     "licen[cs]e or at your option any later version", "foundation"),
    ("gpl-3.0-or-later", "gnu general public licen[cs]e as published by the free software foundation either version 3 of the "
     "licen[cs]e or at your option any later version", "foundation"),
    ("lgpl-2.1-or-later", "gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 "
     "of the licen[cs]e or at your option any later version", "lesser"),
    ("lgpl-2.0-or-later", "gnu library general public licen[cs]e as published by the free software foundation either version 2 "
     "of the licen[cs]e or at your option any later version", "library"),
    ("lgpl-3.0-or-later", "gnu lesser general public licen[cs]e as published by the free software foundation either version 3 "
     "of the licen[cs]e or at your option any later version", "lesser"),
    ("agpl-3.0-or-later", "gnu affero general public licen[cs]e as published by the free software foundation either version 3 "
     "of the licen[cs]e or at your option any later version", "affero"),
    ("gpl-2.0-only", "gnu general public licen[cs]e version 2 (?:only )?as published by the free software foundation", "foundation"),
    ("gpl-2.0-only", "gnu general public licen[cs]e as published by the free software foundation version 2 of the licen[cs]e",
     "foundation"),
    ("gpl-3.0-only", "gnu general public licen[cs]e version 3 (?:only )?as published by the free software foundation", "foundation"),
    ("gpl", "you should have received a copy of the gnu general public licen[cs]e along with this program", "received"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with this library",
     "received"),
    ("agpl", "you should have received a copy of the gnu affero general public licen[cs]e along with this program", "affero"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation "
     "licen[cs]e", "documentation"),
    ("gpl", "may be distributed under the terms of the gnu general public licen[cs]e", "gnu"),
    ("gpl", "alternatively this (?:software|product|file) may be distributed under the terms of the gnu general public licen[cs]e",
     "alternatively"),
    ("gpl-linking-exception", "linking this library statically or dynamically with other modules is making a combined work",
     "statically"),
    ("classpath-exception-2.0", "as a special exception the copyright holders of this library give you permission to link this "
     "library with independent modules", "independent"),
    ("gcc-exception-3.1", "gcc runtime library exception version 3 1", "gcc"),
    ("bison-exception-2.2", "as a special exception you may create a larger work that contains part or all of the bison parser "
     "skeleton", "bison"),
    ("autoconf-exception", "as a special exception the free software foundation gives unlimited permission to copy distribute "
     "and modify the configure scripts", "configure"),
    # Permissive texts.
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "software", "substantial"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability", "merchantability"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
     "action of contract tort or otherwise", "tort"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish",
     "merge"),
    ("mit", "(?:released|licensed|distributed|available) under the (?:terms of the )?mit licen[cs]e", "mit"),
    ("mit", "use of this source code is governed by an mit style licen[cs]e", "mit"),
    ("mit-0", "mit no attribution", "attribution"),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used in advertising", "consortium"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software", "disclaims"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice", "granted"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "the software is provided", "granted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer", "redistributions"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
     "disclaimer", "redistributions"),
    ("bsd-3-clause", "nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from "
     "this software", "endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following "
     "acknowledge?ment", "advertising"),
    ("bsd", "this software is provided by the (?:copyright holders and contributors|regents and contributors|author) as is and any "
     "express or implied warranties", "implied"),
    ("bsd", "in no event shall the (?:copyright (?:holder|owner)s?|regents|author) or contributors be liable for any direct indirect "
     "incidental special exemplary or consequential damages", "exemplary"),
    ("bsd-3-clause-clear", "no express or implied licen[cs]es to any party s patent rights are granted by this licen[cs]e", "patent"),
    ("bsd", "use of this source code is governed by a bsd style licen[cs]e", "bsd"),
    ("bsd", "(?:released|licensed|distributed) under (?:the|a) (?:terms of the )?bsd (?:style )?licen[cs]e", "bsd"),
    ("bsd-2-clause-views", "the views and conclusions contained in the software and documentation are those of the authors", "views"),
    ("bsd-source-code", "redistributions of source code must retain the original code s copyright", "redistributions"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is "
     "hereby granted", "documentation"),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is "
     "hereby granted", "documentation"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and "
     "without a written agreement is hereby granted", "agreement"),
    ("apache-1.0", "this product includes software developed by the apache group for use in the apache http server project", "apache"),
    ("apache-1.1", "this product includes software developed by the apache software foundation", "apache"),
    ("apache-2.0", "apache licen[cs]e version 2 0 january 2004", "apache"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is "
     "distributed on an as is basis", "basis"),
    ("apache-2.0", "licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements", "asf"),
    ("apache-2.0", "subject to the terms and conditions of this licen[cs]e each contributor hereby grants to you a perpetual "
     "worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e", "irrevocable"),
    ("apache-2.0", "apache org licenses licen[cs]e 2 0", "apache"),
    ("apache-2.0", "(?:released|licensed|distributed|available) under the (?:terms of the )?apache 2 0 licen[cs]e", "apache"),
    ("llvm-exception", "llvm exceptions to the apache 2 0 licen[cs]e", "llvm"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
     "misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
     "misrepresented"),
    ("libpng", "the origin of this source code must not be misrepresented", "misrepresented"),
    ("bsl-1.0", "boost software licen[cs]e version 1 0 august 17th 2003", "boost"),
    ("bsl-1.0", "distributed under the boost software licen[cs]e version 1 0", "boost"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
     "accompanying documentation", "accompanying"),
    ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal with the software without restriction", "granted"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
     "as a compiled binary", "compile"),
    ("unlicense", "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all "
     "copyright interest", "dedicate"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document and changing it "
     "is allowed as long as the name is changed", "verbatim"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", "stuff"),
    ("blueoak-1.0.0", "blue oak model licen[cs]e(?: version 1 0 0)?", "oak"),
    ("blueoak-1.0.0", "the purpose of this licen[cs]e is to give everyone as much permission to work with this software as possible "
     "while protecting contributors from liability", "contributors"),
    ("mulanpsl-2.0", "mulan permissive software licen[cs]e(?: version)? v?2", "mulan"),
    ("mulanpsl-1.0", "mulan permissive software licen[cs]e(?: version)? v?1", "mulan"),
    ("mulanpsl-2.0", "you can use this software according to the terms and conditions of the mulan psl v2", "mulan"),
    ("mulanpsl", "mulan psl v?[12]", "mulan"),
    ("upl-1.0", "the universal permissive licen[cs]e upl version 1 0", "universal"),
    ("afl-3.0", "licensed under the academic free licen[cs]e version 3 0", "academic"),
    ("ms-pl", "this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e",
     "accompanying"),
    ("ecl-2.0", "educational community licen[cs]e version 2 0", "educational"),
    ("python-2.0", "this licen[cs]e agreement is between the python software foundation", "python"),
    ("python-2.0", "python software foundation licen[cs]e version 2", "python"),
    ("cnri-python", "this licen[cs]e agreement is between the corporation for national research initiatives", "initiatives"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", "openssl"),
    ("ssleay", "this package is an ssl implementation written by eric young", "ssl"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "granted"),
    ("icu", "unicode inc licen[cs]e agreement data files and software", "unicode"),
    ("unicode-dfs", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", "unicode"),
    ("ijg", "this software is based in part on the work of the independent jpeg group", "jpeg"),
    ("ftl", "portions of this software are copyright (?:c )?the freetype project", "freetype"),
    ("php-3.01", "the php licen[cs]e version 3 01", "php"),
    ("php", "this product includes php software freely available from", "php"),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction", "verbatim"),
    ("vim", "there are no restrictions on distributing unmodified copies of vim", "vim"),
    ("tcl", "this software is copyrighted by the regents of the university of california sun microsystems inc scriptics corporation",
     "scriptics"),
    ("w3c", "by obtaining and or copying this work you the licensee agree that you have read understood and will comply", "licensee"),
    ("zpl", "zope public licen[cs]e zpl version", "zope"),
    ("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code", "accompanied"),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", "intent"),
    ("artistic-2.0", "the artistic licen[cs]e 2 0 copyright", "artistic"),
    ("perl", "this (?:library|program|module) is free software you can redistribute it and or modify it under the same terms as perl "
     "itself", "perl"),
    ("ofl-1.1", "sil open font licen[cs]e version 1 1 26 february 2007", "sil"),
    ("ofl-1.1", "this font software is licensed under the sil open font licen[cs]e version 1 1", "sil"),
    ("bitstream-vera", "bitstream vera is a trademark of bitstream inc", "bitstream"),
    ("ubuntu-font-1.0", "ubuntu font licen[cs]e version 1 0", "ubuntu"),
    # Weak copyleft.
    ("mpl-1.0", "mozilla public licen[cs]e version 1 0", "mozilla"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public licen[cs]e version 1 1", "mozilla"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "mpl"),
    ("mpl-2.0", "this source code form is incompatible with secondary licen[cs]es", "incompatible"),
    ("epl-1.0", "the accompanying program is provided under the terms of this eclipse public licen[cs]e", "eclipse"),
    ("epl-1.0", "made available under the terms of the eclipse public licen[cs]e v1 0", "eclipse"),
    ("epl-2.0", "made available under the terms of the eclipse public licen[cs]e (?:v ?)?2 0", "eclipse"),
    ("epl-2.0", "eclipse public licen[cs]e v 2 0", "eclipse"),
    ("edl-1.0", "eclipse distribution licen[cs]e v(?:ersion)? ?1 0", "eclipse"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution licen[cs]e",
     "distribution"),
    ("cddl-1.1", "common development and distribution licen[cs]e cddl version 1 1", "cddl"),
    ("cpl-1.0", "the accompanying program is provided under the terms of this common public licen[cs]e", "common"),
    ("ipl-1.0", "the accompanying program is provided under the terms of this ibm public licen[cs]e", "ibm"),
    ("cecill-2.1", "cecill free software licen[cs]e agreement version 2 1", "cecill"),
    ("cecill-2.0", "cecill free software licen[cs]e agreement version 2 0", "cecill"),
    ("cecill-b", "cecill b free software licen[cs]e agreement", "cecill"),
    ("cecill-c", "cecill c free software licen[cs]e agreement", "cecill"),
    ("cecill", "this software is governed by the cecill(?: [bc])? licen[cs]e under french law", "cecill"),
    ("eupl-1.1", "european union public licen[cs]e v ?1 1", "european"),
    ("eupl-1.2", "european union public licen[cs]e v ?1 2", "european"),
    ("eupl-1.2", "licensed under the eupl version 1 2", "eupl"),
    ("osl-3.0", "licensed under the open software licen[cs]e version 3 0", "open"),
    ("apsl-2.0", "apple public source licen[cs]e(?: ver(?:sion)?)? 2 0", "apple"),
    ("apsl", "this file contains original code and or modifications of original code as defined in and that are subject to the apple "
     "public source licen[cs]e", "apple"),
    ("qpl-1.0", "the q public licen[cs]e version 1 0", "q"),
    ("spl-1.0", "sun public licen[cs]e version 1 0", "sun"),
    ("npl-1.1", "netscape public licen[cs]e version 1 1", "netscape"),
    ("lppl-1.3", "latex project public licen[cs]e either version 1 3", "latex"),
    ("lppl", "this work may be distributed and or modified under the conditions of the latex project public licen[cs]e", "latex"),
    ("odbl-1.0", "is made available under the open database licen[cs]e", "database"),
    ("odc-by-1.0", "open data commons attribution licen[cs]e", "commons"),
    ("pddl-1.0", "open data commons public domain dedication and licen[cs]e", "commons"),
    # Source-available terms.
    ("busl-1.1", "business source licen[cs]e 1 1", "business"),
    ("busl", "business source licen[cs]e", "business"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make "
     "non production use of the licensed work", "licensor"),
    ("sspl-1.0", "server side public licen[cs]e(?: version 1| v1)?", "server"),
    ("sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service",
     "functionality"),
    ("elastic-2.0", "elastic licen[cs]e 2 0", "elastic"),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", "hosted"),
    ("commons-clause", "commons clause licen[cs]e condition v1 0", "clause"),
    ("commons-clause", "the grant of rights under the licen[cs]e will not include and the licen[cs]e does not grant to you the right "
     "to sell the software", "sell"),
    ("polyform-noncommercial-1.0.0", "polyform noncommercial licen[cs]e 1 0 0", "polyform"),
    ("polyform-small-business-1.0.0", "polyform small business licen[cs]e 1 0 0", "polyform"),
    ("polyform-shield-1.0.0", "polyform shield licen[cs]e 1 0 0", "polyform"),
    ("confluent-1.0", "confluent community licen[cs]e(?: agreement)?(?: version 1 0)?", "confluent"),
    ("json", "the software shall be used for good not evil", "evil"),
    ("hippocratic", "hippocratic licen[cs]e", "hippocratic"),
    ("llama2", "llama 2 community licen[cs]e agreement", "llama"),
    ("llama3", "meta llama 3(?: 1)? community licen[cs]e(?: agreement)?", "llama"),
    ("openrail-m", "bigscience (?:open )?rail licen[cs]e|creativeml open rail m", "rail"),
    # Creative Commons deeds and notices.
    ("cc0-1.0", "cc0 1 0 universal", "cc0"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain", "deed"),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights", "waived"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international licen[cs]e", "creative"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution share ?alike 4 0 international licen[cs]e",
     "creative"),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution non ?commercial 4 0 international licen[cs]e",
     "creative"),
    ("cc-by-nd-4.0", "this work is licensed under a creative commons attribution no ?derivatives 4 0 international licen[cs]e",
     "creative"),
    ("cc-by-nc-sa-4.0", "this work is licensed under a creative commons attribution non ?commercial share ?alike 4 0 international "
     "licen[cs]e", "creative"),
    ("cc-by-nc-nd-4.0", "this work is licensed under a creative commons attribution non ?commercial no ?derivatives 4 0 international "
     "licen[cs]e", "creative"),
    ("cc-by-3.0", "creative commons attribution 3 0 unported", "creative"),
    ("cc-by-sa-3.0", "creative commons attribution share ?alike 3 0 unported", "creative"),
    ("cc-by-4.0", "creativecommons org licenses by 4 0", "creativecommons"),
    ("cc-by-3.0", "creativecommons org licenses by 3 0", "creativecommons"),
    ("cc-by-sa-4.0", "creativecommons org licenses by sa 4 0", "creativecommons"),
    ("cc-by-sa-3.0", "creativecommons org licenses by sa 3 0", "creativecommons"),
    ("cc-by-nc-4.0", "creativecommons org licenses by nc 4 0", "creativecommons"),
    ("cc-by-nc-sa-4.0", "creativecommons org licenses by nc sa 4 0", "creativecommons"),
    ("cc-by-nc-nd-4.0", "creativecommons org licenses by nc nd 4 0", "creativecommons"),
    ("cc0-1.0", "creativecommons org publicdomain zero 1 0", "creativecommons"),
    ("cc", "some rights reserved", "reserved"),
    # Rights kept, and works of none.
    ("proprietary", "proprietary and confidential", "proprietary confidential"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", "unauthorized"),
    ("proprietary", "no part of this (?:publication|work|document|book) may be reproduced",
     "reproduced"),
    ("proprietary", "this software is licensed not sold", "licensed"),
    ("proprietary", "end user licen[cs]e agreement", "user"),
    ("proprietary", "you may not reverse engineer decompile or disassemble", "decompile"),
    ("proprietary", "for internal use only", "internal"),
    ("public-domain", "this (?:work|file|software|program|code) is in the public domain", "domain"),
    ("public-domain", "no copyright is claimed", "claimed"),
    ("public-domain", "this is a work of the (?:u s|united states) government", "government"),
    ("public-domain", "the author disclaims copyright to this source code", "disclaims"),
)

# Identifiers that stand in tags and manifests, besides those of the families (fixed values).
IDENTIFIERS = (
    "mit", "mit-0", "isc", "0bsd", "bsd-1-clause", "bsd-2-clause", "bsd-3-clause", "bsd-3-clause-clear", "bsd-4-clause", "zlib",
    "libpng-2.0", "unlicense", "wtfpl", "ncsa", "postgresql", "openssl", "x11", "curl", "icu", "hpnd", "ntp", "python-2.0",
    "psf-2.0", "ruby", "vim", "tcl", "w3c", "upl-1.0", "ecl-2.0", "ms-pl", "ms-rl", "mulanpsl-1.0", "mulanpsl-2.0",
    "blueoak-1.0.0", "cc0-1.0", "cecill-2.0", "cecill-2.1", "cecill-b", "cecill-c", "busl-1.1", "sspl-1.0", "elastic-2.0",
    "apsl-2.0", "json", "beerware", "pddl-1.0", "odc-by-1.0", "bsd-2-clause-patent", "afl-3.0", "qpl-1.0", "sleepycat",
)
