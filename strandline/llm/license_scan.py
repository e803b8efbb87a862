"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment."""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm.common import lean

# Fixed values of the contract: phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Hand-written names of licenses, in words: label, keyword that any text of it has, name (regex over words), versions.
# The label of a version is label-version; a family without versions has its label only.
FAMILIES = [
    ("apache", "apache", r"apache(?: software)?", ["1 0", "1 1", "2 0"]),
    ("mit", "mit", r"(?:the )?mit(?: x11)?", []),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)", []),
    ("bsd-3-clause", "bsd", r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd)", []),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)", []),
    ("0bsd", "0bsd", r"(?:zero clause bsd )?0bsd", []),
    ("gpl", "gpl", r"(?:gnu )?gpl", ["1 0", "2 0", "3 0"]),
    ("gpl", "general", r"(?:gnu )?general public license", ["1 0", "2 0", "3 0"]),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", ["2 0", "2 1", "3 0"]),
    ("lgpl", "general", r"(?:gnu )?(?:lesser|library) general public license", ["2 0", "2 1", "3 0"]),
    ("agpl", "agpl", r"(?:gnu )?agpl", ["1 0", "3 0"]),
    ("agpl", "affero", r"(?:gnu )?affero general public license", ["1 0", "3 0"]),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license", ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla", r"mozilla public license", ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", r"mpl", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", r"eclipse public license", ["1 0", "2 0"]),
    ("edl", "distribution", r"eclipse distribution license", ["1 0"]),
    ("eupl", "european", r"european union public licen[cs]e", ["1 0", "1 1", "1 2"]),
    ("eupl", "eupl", r"eupl", ["1 0", "1 1", "1 2"]),
    ("cddl", "cddl", r"cddl", ["1 0", "1 1"]),
    ("cddl", "distribution", r"common development and distribution license", ["1 0", "1 1"]),
    ("cpl", "common", r"common public license", ["1 0"]),
    ("artistic", "artistic", r"(?:perl )?artistic", ["1 0", "2 0"]),
    ("bsl", "boost", r"boost software", ["1 0"]),
    ("isc", "isc", r"isc", []),
    ("zlib", "zlib", r"zlib(?: libpng)?", []),
    ("unlicense", "unlicense", r"(?:the )?unlicense", []),
    ("wtfpl", "wtfpl", r"wtfpl", []),
    ("ofl", "font", r"(?:sil )?open font", ["1 0", "1 1"]),
    ("psf", "python", r"python software foundation", ["2 0"]),
    ("postgresql", "postgresql", r"postgresql", []),
    ("ms-pl", "microsoft", r"microsoft public", []),
    ("ms-rl", "microsoft", r"microsoft reciprocal", []),
    ("osl", "open software", r"open software", ["1 0", "2 0", "3 0"]),
    ("afl", "academic", r"academic free", ["2 1", "3 0"]),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", []),
    ("openssl", "openssl", r"openssl", []),
    ("php", "php", r"php", ["3 0", "3 01"]),
    ("ruby", "ruby", r"ruby", []),
    ("x11", "x11", r"x11", []),
    ("mulan", "mulan", r"mulan (?:permissive software|psl)", ["1 0", "2 0"]),
    ("busl", "business source", r"business source", ["1 1"]),
    ("sspl", "server side", r"server side public license", ["1 0"]),
    ("elastic", "elastic", r"elastic", ["1 0", "2 0"]),
    ("odbl", "database", r"open (?:data commons open )?database", ["1 0"]),
    ("odc-by", "commons", r"open data commons attribution", ["1 0"]),
    ("pddl", "dedication", r"public domain dedication and license", ["1 0"]),
    ("cc0", "cc0", r"cc0", ["1 0"]),
    ("cc0", "zero", r"creative commons zero", ["1 0"]),
    ("cc-by", "cc by", r"cc by", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc by", r"cc by sa", ["2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc by", r"cc by nd", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc", "cc by", r"cc by nc", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc by", r"cc by nc sa", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-nd", "cc by", r"cc by nc nd", ["2 0", "3 0", "4 0"]),
    ("cc-by", "attribution", r"creative commons attribution", ["2 0", "3 0", "4 0"]),
    ("cc-by-sa", "attribution", r"creative commons attribution share ?alike", ["2 0", "3 0", "4 0"]),
    ("cc-by-nd", "derivatives", r"creative commons attribution no ?derivatives", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc", "commercial", r"creative commons attribution non ?commercial", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-sa", "commercial", r"creative commons attribution non ?commercial share ?alike", ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-nd", "commercial", r"creative commons attribution non ?commercial no ?derivatives", ["2 0", "3 0", "4 0"]),
]

# Phrases of license texts: label, keyword, regex over words, priority.
TEXTS = [
    ("mit", "free of charge", r"permission is hereby granted free of charge to any person obtaining a copy", 95),
    ("mit", "without restriction", r"to deal in the software without restriction including without limitation the rights", 95),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose", 95),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice", 95),
    ("bsd-3-clause", "endorse", r"neither the name of .{1,80}? may be used to endorse or promote products", 95),
    ("apache-2.0", "in compliance", r"you may not use this file except in compliance with the license", 90),
    ("apache-2.0", "apache org", r"www apache org licenses license 2 0", 95),
    ("gpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu general public license", 95),
    ("lgpl", "redistribute it", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", 95),
    ("agpl", "affero", r"under the terms of the gnu affero general public license", 95),
    ("gpl-2.0", "gnu org", r"www gnu org licenses (?:old licenses )?gpl 2 0", 95),
    ("gpl-3.0", "gnu org", r"www gnu org licenses gpl 3 0", 95),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", 97),
    ("mpl-2.0", "mozilla org", r"mozilla org mpl 2 0", 95),
    ("bsl-1.0", "boost", r"boost org license 1 0 txt", 95),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty", 90),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 95),
    ("unlicense", "unlicense org", r"unlicense org", 90),
    ("wtfpl", "the fuck", r"do what the fuck you want to public license", 95),
    ("cc0", "publicdomain", r"creativecommons org publicdomain zero 1 0", 95),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]", 95),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]", 95),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]", 95),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]", 95),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]", 95),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]", 95),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain", 60),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary)", 70),
    ("proprietary", "trade secret", r"(?:unpublished|contains) trade secrets?", 60),
    ("proprietary", "without", r"without (?:the )?(?:prior|express) written (?:permission|consent)", 50),
    ("reserved", "reserved", r"no rights reserved", 40),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", 20),
    ("permissive", "permitted", r"redistribution and use in source and binary forms with or without modification are permitted", 85),
    ("other", "licen", r"licensed under(?: the)?(?: terms of)?", 5),
    # permissive texts
    ("mit", "above copyright", r"the above copyright notice and this permission notice shall be included in all copies", 95),
    ("mit", "merge", r"use copy modify merge publish distribute sublicense and or sell copies of the software", 95),
    ("mit", "noninfringement", r"merchantability fitness for a particular purpose and noninfringement", 60),
    ("mit-0", "no attribution", r"mit no attribution(?: license)?", 92),
    ("mit-modern", "hereby granted", r"permission is hereby granted without written agreement and without license or royalty fees", 92),
    ("bsd", "binary form", r"redistributions in binary form must reproduce the above copyright notice", 95),
    ("bsd", "software is provided", r"this software is provided by the (?:copyright holders|regents|author)(?: and contributors)? as is", 88),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display", 96),
    ("bsd-2-clause-patent", "patent", r"bsd (?:2 clause )?plus patent(?: license)?", 92),
    ("bsd-3-clause-clear", "clear", r"(?:the )?clear bsd license", 92),
    ("isc", "without fee", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", 96),
    ("zlib", "altered source", r"altered source versions must be plainly marked as such", 95),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", 95),
    ("libpng", "png", r"(?:libpng|png) (?:reference library )?licen[cs]e(?: version 2)?", 85),
    ("curl", "curl", r"curl (?:and libcurl )?licen[cs]e", 80),
    ("x11", "x consortium", r"except as contained in this notice the name of the x consortium shall not be used", 96),
    ("ncsa", "illinois", r"university of illinois ncsa open source license", 94),
    ("boost", "machine executable", r"solely in the form of machine executable object code generated by a source language processor", 95),
    ("postgresql", "california", r"in no event shall the university of california be liable to any party", 90),
    ("python", "beopen", r"beopen python open source license agreement", 94),
    ("python", "cnri", r"cnri (?:open source )?(?:gpl compatible )?license agreement", 92),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project", 95),
    ("ssleay", "eric young", r"this product includes cryptographic software written by eric young", 95),
    ("icu", "icu", r"icu licen[cs]e(?: icu 1 8 1 and later)?", 80),
    ("unicode", "unicode", r"unicode(?: inc)? licen[cs]e(?: agreement)?(?: v3)?(?: data files and software)?", 85),
    ("w3c", "w3c", r"w3c software (?:notice and|and document) (?:licen[cs]e|notice)", 90),
    ("beerware", "beer", r"(?:the )?beer ?ware licen[cs]e(?: revision 42)?", 90),
    ("beerware", "buy me a beer", r"you can buy me a beer in return", 95),
    ("json", "good not evil", r"the software shall be used for good not evil", 96),
    ("fair", "works", r"usage of the works is permitted provided that this instrument is retained with the works", 95),
    ("hpnd", "representations", r"makes no representations about the suitability of this software for any purpose", 90),
    ("upl", "universal permissive", r"universal permissive licen[cs]e(?: v| version)? ?1 0", 92),
    ("bluoak", "blue oak", r"blue oak model licen[cs]e 1 0 0", 92),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e ms pl", 92),
    ("ftl", "freetype", r"freetype (?:project )?licen[cs]e", 88),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group", 95),
    ("info-zip", "info zip", r"info zip licen[cs]e", 85),
    ("tcl", "tcl", r"tcl tk licen[cs]e", 85),
    ("vim", "vim", r"vim licen[cs]e", 80),
    # copyleft texts
    ("gpl", "free software foundation", r"as published by the free software foundation either version [1-3](?: of the license)? or (?:at your option )?any later version", 94),
    ("gpl", "any warranty", r"this program is distributed in the hope that it will be useful but without any warranty", 93),
    ("gpl", "received a copy", r"you should have received a copy of the gnu general public license", 95),
    ("lgpl", "received a copy", r"you should have received a copy of the gnu (?:lesser|library) general public license", 95),
    ("agpl", "received a copy", r"you should have received a copy of the gnu affero general public license", 95),
    ("gpl-2.0", "june 1991", r"gnu general public license version 2 june 1991", 97),
    ("gpl-3.0", "june 2007", r"gnu general public license version 3 29 june 2007", 97),
    ("lgpl-2.1", "february 1999", r"gnu lesser general public license version 2 1 february 1999", 97),
    ("lgpl-3.0", "june 2007", r"gnu lesser general public license version 3 29 june 2007", 98),
    ("agpl-3.0", "november 2007", r"gnu affero general public license version 3 19 november 2007", 97),
    ("gpl-classpath", "classpath", r"(?:gpl )?(?:with )?classpath exception", 90),
    ("gpl-gcc", "gcc runtime", r"gcc runtime library exception", 92),
    ("gpl-linking", "linking exception", r"(?:gpl )?(?:static )?linking exception", 80),
    ("gpl-font", "font e", r"(?:gpl )?font (?:embedding )?exception", 85),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1", 97),
    ("mpl-2.0", "incompatible", r"incompatible with secondary licenses", 70),
    ("epl-1.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", 97),
    ("epl-2.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", 97),
    ("cddl", "development and distribution", r"subject to the terms of the common development and distribution license", 93),
    ("cpl", "common public", r"accompanying program is provided under the terms of this common public license", 95),
    ("ipl", "ibm public", r"ibm public licen[cs]e(?: version 1 0)?", 88),
    ("cecill", "cecill", r"cecill(?: (?:b|c|1 0|1 1|2 0|2 1))?(?: free software)?(?: licen[cs]e)?", 82),
    ("artistic", "artistic", r"the clarified artistic licen[cs]e", 90),
    ("perl", "same terms", r"(?:under the )?same terms as perl(?: itself)?", 90),
    ("ruby", "same terms", r"(?:under the )?same terms as ruby(?: itself)?", 90),
    ("qpl", "q public", r"(?:the )?q public licen[cs]e(?: version 1 0)?", 88),
    ("apsl", "apple public", r"apple public source licen[cs]e(?: version| v)?(?: (?:1 0|1 1|1 2|2 0))?", 88),
    ("nposl", "non profit", r"non profit open software licen[cs]e(?: 3 0)?", 88),
    ("oclc", "oclc", r"oclc research public licen[cs]e(?: 2 0)?", 88),
    ("sleepycat", "sleepycat", r"(?:the )?sleepycat licen[cs]e", 88),
    ("rpl", "reciprocal public", r"reciprocal public licen[cs]e(?: 1 [135])?", 88),
    ("ecos", "ecos", r"ecos licen[cs]e(?: version 2 0)?", 85),
    ("copyleft-next", "copyleft next", r"copyleft next(?: 0 3 [01])?", 85),
    # apache and patents
    ("apache-2.0", "applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 94),
    ("apache-2.0", "apache", r"apache license version 2 0 january 2004", 97),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation", 93),
    ("apache-llvm", "llvm", r"apache licen[cs]e v?2 0 with llvm exceptions?", 96),
    ("apache-commons-clause", "commons clause", r"commons clause(?: licen[cs]e condition)?(?: v?1 0)?", 92),
    # documents, media and data
    ("gfdl", "invariant sections", r"with no invariant sections(?: no| with no)? front cover texts", 95),
    ("gfdl", "documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 96),
    ("cc-by", "attribution", r"(?:licensed|available|released) under (?:a |the )?creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 92),
    ("cc-by-sa", "attribution", r"(?:licensed|available|released) under (?:a |the )?creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 94),
    ("cc-by-nc", "commercial", r"(?:licensed|available|released) under (?:a |the )?creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 94),
    ("cc-by-nd", "deriv", r"(?:licensed|available|released) under (?:a |the )?creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?(?: international| unported| generic)? licen[cs]e", 94),
    ("cc0", "cc0", r"cc0 (?:1 0 )?(?:universal )?public domain dedication", 95),
    ("cc0", "waived all", r"has waived all copyright and related or neighboring rights", 95),
    ("cc-pdm", "public domain mark", r"(?:creative commons )?public domain mark(?: 1 0)?", 90),
    ("odbl", "odbl", r"open database licen[cs]e odbl(?: v?1 0)?", 95),
    ("odbl", "openstreetmap", r"openstreetmap contributors", 60),
    ("odc-by", "odc", r"odc (?:by|attribution)(?: v?1 0)?(?: licen[cs]e)?", 90),
    ("pddl", "pddl", r"(?:odc )?pddl(?: v?1 0)?", 80),
    ("cdla-permissive", "community data", r"community data licen[cs]e agreement permissive(?: version)?(?: [12] 0)?", 94),
    ("cdla-sharing", "community data", r"community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?", 94),
    ("ogl-uk", "open government", r"open government licen[cs]e(?: v| version)? ?(?:[123] 0)?", 90),
    ("etalab", "licence ouverte", r"licence ouverte(?: open licence)?(?: version)?(?: [12] 0)?", 90),
    ("dl-de", "datenlizenz", r"datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?", 90),
    ("gutenberg", "gutenberg", r"(?:full )?project gutenberg(?: tm)? licen[cs]e", 92),
    ("ofl", "font software", r"this font software is licensed under the sil open font license", 97),
    ("ofl", "reserved font", r"with reserved font names?", 85),
    ("bitstream-vera", "bitstream", r"bitstream vera(?: fonts)?(?: copyright)?(?: licen[cs]e)?", 75),
    ("ubuntu-font", "ubuntu font", r"ubuntu font licen[cs]e(?: version)?(?: 1 0)?", 92),
    # source available and models
    ("busl-1.1", "change date", r"change date .{1,40}? change license", 90),
    ("busl-1.1", "production use", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", 97),
    ("sspl-1.0", "service source code", r"you must make the service source code available via network download to everyone", 97),
    ("elastic-2.0", "managed service", r"you may not provide the software to third parties as a hosted or managed service", 97),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|perimeter|shield|strict|internal use|free trial)(?: licen[cs]e)?(?: 1 0 0)?", 92),
    ("prosperity", "prosperity", r"(?:the )?prosperity public licen[cs]e(?: 3 0 0)?", 90),
    ("parity", "parity", r"(?:the )?parity public licen[cs]e(?: 7 0 0)?", 90),
    ("fsl", "functional source", r"functional source licen[cs]e(?: version)?(?: 1 [01])?", 92),
    ("openrail", "rail", r"(?:creativeml |bigscience |bigcode )?open ?rail(?: [ms]| m\+\+)?(?: licen[cs]e)?(?: v?1)?", 80),
    ("responsible-ai", "responsible ai", r"responsible ai licen[cs]e", 90),
    ("llama", "llama", r"llama (?:2|3|3 1|3 2|3 3|4)? ?community licen[cs]e(?: agreement)?", 92),
    ("gemma", "gemma", r"gemma terms of use", 90),
    ("ethical", "hippocratic", r"hippocratic licen[cs]e(?: version)?(?: [123] [01])?", 90),
    # rights held back
    ("proprietary", "confidential", r"this (?:document|software|file|material) (?:is|contains) confidential(?: and proprietary)?(?: information)?", 72),
    ("proprietary", "unauthori", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: or (?:copying|use|reproduction|distribution))?(?: of this (?:file|software|document|material))? .{0,40}?(?:is )?(?:strictly )?prohibited", 75),
    ("proprietary", "end user", r"end user licen[cs]e agreement", 55),
    ("proprietary", "reverse engineer", r"(?:may|shall|must) not (?:copy modify )?(?:decompile disassemble or )?reverse engineer", 65),
    ("proprietary", "no part", r"no part of this (?:publication|book|document|work) may be reproduced", 75),
    ("proprietary", "internal use", r"for internal use only", 45),
    ("proprietary", "not for", r"not for (?:resale|redistribution|commercial use)", 45),
    ("noncommercial", "commercial", r"(?:for )?non ?commercial (?:use|purposes) only", 50),
    ("noncommercial", "personal", r"for personal(?: and)? non ?commercial use(?: only)?", 52),
    ("noncommercial", "for academic", r"for academic(?: and (?:academic|research|educational))? (?:use|purposes) only", 50),
    ("noncommercial", "for research", r"for research(?: and (?:academic|research|educational))? (?:use|purposes) only", 50),
    ("noncommercial", "for educational", r"for educational(?: and (?:academic|research|educational))? (?:use|purposes) only", 50),
    ("reserved", "some rights", r"some rights reserved", 40),
    ("public-domain", "dedicated", r"(?:is )?(?:hereby )?dedicated to the public domain", 75),
    ("public-domain", "public domain", r"(?:placed|released) (?:in|into|to) the public domain", 72),
    ("public-domain", "government", r"work of the (?:united states|u s|us) government", 60),
    ("copyright", "copyright", r"copyright (?:c )?by [a-z]", 18),
    ("copyright", "copyrighted", r"copyrighted (?:material|work|by)", 18),
    ("copyright", "trademark", r"(?:is a |are )?(?:registered )?trademarks? of", 15),
    ("other", "licen", r"licen[cs]e agreement", 5),
    ("other", "licen", r"see (?:the )?licen[cs]e(?: file| txt| md)? for (?:details|more|the full)", 30),
    ("other", "terms and conditions", r"(?:subject to|under) the (?:following )?terms and conditions", 10),
    ("other", "may be freely", r"may be freely (?:copied|distributed|redistributed)(?: (?:and|or) (?:copied|distributed|redistributed|modified))*", 25),
    ("other", "with permission", r"(?:used|reprinted|reproduced) with permission", 35),
]

# How a name stands in a text: wording around {name} and {version}, priority with a version and without.
WORDINGS = [
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?{name}(?: public)?(?: licen[cs]e)?{version}", 80, 65),
    (r"spdx licen[cs]e identifier {name}{version}(?: only| or later)?", 90, 75),
    (r"{name}(?: public)? licen[cs]e{version}", 70, 55),
    (r"{name}{version}", 60, None),
]
VERSION = r"(?: international)?(?: version| v)? ?v?{v}(?: international)?(?: licen[cs]e)?"


class Rule(NamedTuple):
    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int


class Hit(NamedTuple):
    start: int
    end: int
    priority: int
    label: str


def rules() -> list[Rule]:
    """All signature rules, highest priority first: the texts, and each family in each wording, with each version and without."""
    made = [(label, key, text, priority) for label, key, text, priority in TEXTS]
    for label, key, name, versions in FAMILIES:
        for words, with_version, without in WORDINGS:
            for v in versions:
                number = v.removesuffix(" 0") + "(?: 0)?" if v.endswith(" 0") else v
                made.append((f"{label}-{v.replace(' ', '.')}", key, words.format(name=f"(?:{name})", version=VERSION.format(v=f"(?:{number})")), with_version))
            if without is None and name.endswith("license"):
                without = 55  # a name that says license stands for itself
            if without is not None:
                made.append((label, key, words.format(name=f"(?:{name})", version=""), without))
    made.sort(key=lambda x: -x[3])
    return [Rule(label, key.encode(), re.compile(rb"(?:(?<= )|(?<=^))" + text.strip().encode() + rb"(?= |$)"), priority) for label, key, text, priority in made]


def resolve(hits: list[Hit]) -> list[Hit]:
    """Keeps a hit unless one of at least its priority contains it; of equal spans and priorities the smaller label stays.

    Hits are taken from high priority to low, wide ones first. A binary tree over the starts holds the furthest end of what is
    kept up to there, so each hit costs a logarithm of their number.
    """
    starts = {s: i + 1 for i, s in enumerate(sorted({h.start for h in hits}))}
    furthest = [-1] * (len(starts) + 1)
    kept: list[Hit] = []
    for hit in sorted(hits, key=lambda h: (-h.priority, h.start - h.end, h.start, h.label)):
        i, end = starts[hit.start], -1
        while i:
            end = max(end, furthest[i])
            i &= i - 1
        if end < hit.end:
            kept.append(hit)
            i = starts[hit.start]
            while i < len(furthest):
                furthest[i] = max(furthest[i], hit.end)
                i += i & -i
    return sorted(kept)


#: Bytes of a word stay, A-Z in lower case; all else is a space. Bytes of non-ASCII characters are word bytes.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Scanner:
    def __init__(self) -> None:
        self.rules = rules()
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for rule in self.rules:
            self.by_keyword.setdefault(rule.keyword, []).append(rule)
        self.base = [(label, re.compile(rb"(?:(?<= )|(?<=^))" + phrase.encode() + rb"(?= |$)"), phrase.encode()) for phrase, label in BASE.items()]
        self.keywords = ahocorasick.Automaton()
        for word in {*self.by_keyword, *(p for _, _, p in self.base)}:
            self.keywords.add_word(word.decode(), word)
        self.keywords.make_automaton()
        #: No rule can match a text that has none of these stems; bytes.find runs over them far faster than the automaton.
        self.stems = shortest_stems({*self.by_keyword, *(p for _, _, p in self.base)})

    def scan(self, text: bytes) -> dict:
        words = text.translate(WORD_BYTES).split()
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
        line = b" ".join(words)  # stems hold spaces, so they are looked for where one space parts any two words
        if not any(stem in line for stem in self.stems):
            return out
        found = {word for _, word in self.keywords.iter(line.decode("utf-8", "replace"))}
        if not found:
            return out
        starts = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
        word_at = lambda at: bisect.bisect_right(starts, at) - 1
        base = [(m.start(), m.end(), label) for label, pattern, phrase in self.base if phrase in found for m in pattern.finditer(line)]
        hits = [Hit(m.start(), m.end(), rule.priority, rule.label) for key in found for rule in self.by_keyword.get(key, ()) for m in rule.pattern.finditer(line)]
        hits = resolve(hits)
        labels = {label for *_, label in base}
        out["n_base"] = len(base)
        if base:
            out["first_word"], out["last_word"] = word_at(min(base)[0]), word_at(max(base)[0])
        out["base_labels"] = ",".join(sorted(labels))
        out["labels"] = ",".join(sorted(labels | {h.label for h in hits}))
        out["score"] = max([0.6 * bool(base), *(h.priority / 100 for h in hits)])
        out["spans"] = [{"first": word_at(h.start), "last": word_at(h.end - 1), "label": h.label, "priority": h.priority} for h in hits]
        return out


def shortest_stems(keywords: set[bytes]) -> list[bytes]:
    """Keywords without those that hold another one."""
    return sorted(k for k in keywords if not any(o != k and o in k for o in keywords))


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<first:long,last:long,label:string,priority:long>>"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: base phrases, labels of all rules that stand after suppression, a score and the rules' spans in words.

    The base phrases are counted apart from the rules and never suppressed. The score is the highest priority that stands, in
    hundredths, 0.6 at least with a base phrase, 0 without any hit. Null, empty and wordless texts have no words and no hits.
    Equal rows come out as often as they come in, a null doc_id stays null, other columns are ignored. Each row is scanned
    where it is read; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = [scanner.scan(x.as_py() or b"") for x in batch.column(1).cast(pa.large_binary())]
            columns = [batch.column(0), *(pa.array([r[k] for r in rows], t) for k, t in TYPES.items())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *TYPES])

    return docs.select("doc_id", "text").mapInArrow(lean(run), SCHEMA)


TYPES = {
    **dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), pa.int64()), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
    "spans": pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("priority", pa.int64())])),
}
