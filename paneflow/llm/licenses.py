"""Licence scans by sentence rules.

Text is cut into pieces at line ends and behind marks of punctuation, and normalised (lower case,
letters and digits only, so signs of comments are gone; the words ``dnl`` and ``rem`` at the start
of a line too). One piece or several in a row make up a known sentence, as a notice may be wrapped
over lines, and a known sentence may hold a colon or semicolon; of several the longest counts.
Known sentences are listed, or made of a phrase and a licence's name ("released under the" "mit license"), or
of the words of an SPDX line, or of "license", and a short name. Known sentences have identifiers; a document's identifiers in order are matched against licence
rules, each a run of identifiers. Rules are tried in their order, longer ones first; a run that
is matched is used up, so the parts of a full licence do not count again. A piece that speaks
of licensing but is part of no known sentence is counted as ``n_unknown``.

Cases: a null or empty text has no sentences; pieces without letters and digits do not part a
sentence; repeated rows stay; a licence found twice is named once, at its rule's place; an empty
table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import let

#: Licence sentences as their texts have them, normalised, and our identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheRef",
    "licensed under the apache license version 2 0 the license": "ApacheRefLong",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITRef",
    "licensed under the mit license": "MITRef",
    "this project is licensed under the mit license": "MITRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITAsIs",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDPermit",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDAsIs",
    "this work is licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 3": "GPL3Ref",
    "licensed under the gnu general public license version 2": "GPL2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3Plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2Plus",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLHope",
    "see the gnu general public license for more details": "GPLSee",
    "you should have received a copy of the gnu general public license along with this program": "GPLReceived",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3Plus",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2Ref",
    "licensed under cc by nc 4 0": "CCBYNC4Ref",
    "licensed under cc by 4 0": "CCBY4Ref",
    "licensed under cc by sa 4 0": "CCBYSA4Ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4Ref",
    "this is free and unencumbered software released into the public domain": "UnlicenseRef",
    "all rights reserved": "AllRights",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MITGrantShort",
    "the software is provided as is without warranty of any kind": "MITAsIsShort",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0BSDGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCAsIs",
    "this software is provided as is without any express or implied warranty": "ZlibAsIs",
    "in no event will the authors be held liable for any damages arising from the use of this software": "ZlibLiable",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "BoostGrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3Plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation version 3": "AGPL3Only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2": "GPL2Only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GPL2Only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3": "GPL3Only",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21Plus",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version": "LGPL2Plus",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution": "EPL1Made",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at": "EPL2Made",
    "if a copy of the mpl was not distributed with this file you can obtain one at": "MPL2Obtain",
    "the contents of this file are subject to the terms of the common development and distribution license": "CDDLSubject",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law": "CC0Waive",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed": "GNUVerbatim",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "UnlicenseFree",
}

#: Names that licences go by, normalised.
NAMES = {
    "AGPL-3.0-only": ("gnu affero general public license version 3", "gnu affero general public license v3", "gnu agpl v3", "agpl v3", "agplv3", "agpl 3 0", "agpl 3"),
    "AGPL-3.0-or-later": ("gnu affero general public license version 3 or later", "agpl 3 0 or later", "agpl 3 or later"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0"),
    "Artistic-2.0": ("artistic license 2 0",),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause new or revised license"),
    "BSL-1.0": ("boost software license version 1 0", "boost software license 1 0"),
    "CC-BY-3.0": ("creative commons attribution 3 0 unported license", "cc by 3 0"),
    "CC-BY-4.0": ("creative commons attribution 4 0 international license", "cc by 4 0 license", "cc by 4 0"),
    "CC-BY-NC-4.0": ("creative commons attribution noncommercial 4 0 international license", "cc by nc 4 0"),
    "CC-BY-NC-SA-4.0": ("creative commons attribution noncommercial sharealike 4 0 international license", "cc by nc sa 4 0"),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0 international license", "cc by sa 4 0"),
    "CC0-1.0": ("cc0 1 0 universal license", "cc0 1 0 universal", "cc0 license", "cc0"),
    "CDDL-1.0": ("common development and distribution license version 1 0", "cddl 1 0"),
    "EPL-1.0": ("eclipse public license version 1 0", "eclipse public license v1 0", "eclipse public license 1 0"),
    "EPL-2.0": ("eclipse public license version 2 0", "eclipse public license v2 0", "eclipse public license 2 0"),
    "EUPL-1.2": ("european union public licence version 1 2", "eupl 1 2"),
    "GPL-2.0-only": ("gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gpl version 2", "gplv2", "gpl 2 0", "gpl 2"),
    "GPL-2.0-or-later": ("gnu general public license version 2 or later", "gpl 2 0 or later", "gpl 2 or later", "gplv2 or later"),
    "GPL-3.0-only": ("gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gpl version 3", "gplv3", "gpl 3 0", "gpl 3"),
    "GPL-3.0-or-later": ("gnu general public license version 3 or later", "gpl 3 0 or later", "gpl 3 or later", "gplv3 or later"),
    "ISC": ("isc license",),
    "LGPL-2.1-only": ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl version 2 1", "lgpl v2 1", "lgpl 2 1"),
    "LGPL-2.1-or-later": ("gnu lesser general public license version 2 1 or later", "lgpl 2 1 or later"),
    "LGPL-3.0-only": ("gnu lesser general public license version 3", "gnu lesser general public license v3", "lgpl version 3", "lgplv3", "lgpl 3 0", "lgpl 3"),
    "LGPL-3.0-or-later": ("gnu lesser general public license version 3 or later", "lgpl 3 0 or later", "lgpl 3 or later"),
    "MIT": ("mit license", "expat license"),
    "MIT-0": ("mit no attribution license",),
    "MPL-1.1": ("mozilla public license version 1 1", "mozilla public license 1 1"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v2 0", "mozilla public license 2 0", "mpl 2 0"),
    "MS-PL": ("microsoft public license",),
    "OFL-1.1": ("sil open font license version 1 1", "sil open font license 1 1"),
    "PSF-2.0": ("python software foundation license version 2", "python software foundation license"),
    "Unlicense": ("unlicense",),
    "WTFPL": ("do what the fuck you want to public license", "wtfpl"),
    "Zlib": ("zlib license", "zlib libpng license"),
}
#: What stands before a name.
PHRASES = (
    "licensed under", "licensed under the", "licensed under the terms of the", "released under", "released under the",
    "released under the terms of the", "distributed under the", "distributed under the terms of the", "available under the",
    "made available under the", "provided under the", "published under the", "this project is licensed under the",
    "this software is licensed under the", "this program is licensed under the", "this library is licensed under the", "this code is licensed under the",
    "this file is licensed under the", "this work is licensed under", "this work is licensed under a", "this work is licensed under the",
    "this project is released under the", "this software is released under the", "this file is part of a work under the",
)
#: What stands before a short name, and short names besides those of ``NAMES``.
SHORT_PHRASES = ("spdx license identifier", "license")
SPDX_MORE = ("0BSD", "AFL-3.0", "BSD-4-Clause", "BlueOak-1.0.0", "CC-BY-SA-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "NCSA", "OpenSSL", "PostgreSQL", "Python-2.0", "Ruby", "UPL-1.0", "Vim", "W3C", "X11", "MIT OR Apache-2.0", "Apache-2.0 OR MIT")


def plain_name(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower()).strip()


#: Licence by its name, by its short name.
BY_NAME = {name: licence for licence, names in NAMES.items() for name in names}
BY_SHORT = {plain_name(short): short for short in (*NAMES, *SPDX_MORE)}

#: Licence rules in their order, as runs of identifiers.
RULES = (
    (("ApacheRefLong", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee"), "Apache-2.0"),
    (("BSDPermit", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs"), "BSD-3-Clause"),
    (("BSDPermit", "BSDSource", "BSDBinary", "BSDAsIs"), "BSD-2-Clause"),
    (("GPL3Plus", "GPLHope", "GPLSee", "GPLReceived"), "GPL-3.0-or-later"),
    (("GPL2Plus", "GPLHope", "GPLSee", "GPLReceived"), "GPL-2.0-or-later"),
    (("MITGrant", "MITNotice", "MITAsIs"), "MIT"),
    (("GPL3Plus", "GPLHope"), "GPL-3.0-or-later"),
    (("GPL2Plus", "GPLHope"), "GPL-2.0-or-later"),
    (("MITGrant", "MITNotice"), "MIT"),
    (("ApacheRefLong",), "Apache-2.0"),
    (("ApacheRef",), "Apache-2.0"),
    (("ISCGrant",), "ISC"),
    (("MITGrantShort",), "MIT"),
    (("ZlibAsIs", "ZlibLiable", "ZlibGrant"), "Zlib"),
    (("ZlibGrant",), "Zlib"),
    (("0BSDGrant",), "0BSD"),
    (("BoostGrant",), "BSL-1.0"),
    (("AGPL3Plus",), "AGPL-3.0-or-later"),
    (("AGPL3Only",), "AGPL-3.0-only"),
    (("GPL2Only",), "GPL-2.0-only"),
    (("GPL3Only",), "GPL-3.0-only"),
    (("LGPL21Plus",), "LGPL-2.1-or-later"),
    (("LGPL2Plus",), "LGPL-2.0-or-later"),
    (("EPL1Made",), "EPL-1.0"),
    (("EPL2Made",), "EPL-2.0"),
    (("CDDLSubject",), "CDDL-1.0"),
    (("CC0Waive",), "CC0-1.0"),
    (("MITRef",), "MIT"),
    (("GPL3Plus",), "GPL-3.0-or-later"),
    (("GPL2Plus",), "GPL-2.0-or-later"),
    (("GPL3Ref",), "GPL-3.0-only"),
    (("GPL2Ref",), "GPL-2.0-only"),
    (("LGPL3Plus",), "LGPL-3.0-or-later"),
    (("MPL2Ref",), "MPL-2.0"),
    (("CCBYNC4Ref",), "CC-BY-NC-4.0"),
    (("CCBYSA4Ref",), "CC-BY-SA-4.0"),
    (("CCBY4Ref",), "CC-BY-4.0"),
    (("UnlicenseRef",), "Unlicense"),
    (("AllRights",), "Proprietary"),
    *((("Name:" + licence,), licence) for licence in NAMES),
    *((("SPDX:" + short,), short) for short in sorted(set(BY_SHORT.values()))),
)

#: A piece without any of these words is not about licensing.
HINT = "(?i)licen[sc]|copyright|permi(t|ss)|redistribut|warrant|rights reserved|free software|public domain"
#: Words, one of which every known sentence holds, and every text that has a piece to count as unknown.
WORDS = "(?i)licen[sc]|permi(t|ss)|redistribut|warrant|reserved|unencumbered|held liable|(released|distributed|available|published|provided|work) under|anyone is free|public domain|obtain one at"
#: What makes a piece that is not known count as unknown.
ABOUT = "licen[sc]e|licensed|redistribut|all rights"


def identifiers() -> dict[str, str]:
    """The identifiers of listed sentences, and of names by ``under``, which stands for any phrase."""
    named = {f"under {name}": f"Name:{licence}" for name, licence in BY_NAME.items()}
    short = {f"{phrase} {plain}": f"SPDX:{name}" for phrase in SHORT_PHRASES for plain, name in BY_SHORT.items()}
    return named | short | SENTENCES


def rule_key(identifiers) -> str:
    """Each identifier between commas of its own, so that runs are substrings."""
    return "".join(f",{x}," for x in identifiers)


#: A known sentence, whose words may lie in several pieces, or else one piece, behind its bar.
_IN_PARTS = [
    "|".join(sorted(SENTENCES, key=len, reverse=True)),
    f"(?:{'|'.join(sorted(PHRASES, key=len, reverse=True))}) (?:{'|'.join(sorted(BY_NAME, key=len, reverse=True))})",
    f"(?:{'|'.join(SHORT_PHRASES)}) (?:{'|'.join(sorted(BY_SHORT, key=len, reverse=True))})",
]
_KNOWN = "|".join(_IN_PARTS).replace(" ", "[ |]")
#: The phrase of a sentence made of one and a name.
PHRASE = f"^(?:{'|'.join(sorted(PHRASES, key=len, reverse=True))}) (?={'|'.join(sorted(BY_NAME, key=len, reverse=True))})"
FOUND = rf"\|({_KNOWN}|[^|]*)(?=\|)"


def sentences(text: Column) -> Column:
    """Known sentences, and the pieces between them, in order and normalised; a bar for each cut inside."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?;:])[\x20\x09-\x0D]+", "$1\n")
    plain = F.transform(F.split(marked, "\n"), lambda s: F.regexp_replace(F.btrim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")), "^(dnl|rem) ", ""))
    barred = F.concat(F.lit("|"), F.array_join(F.filter(plain, lambda s: s != ""), "|"), F.lit("|"))
    return F.regexp_extract_all(barred, F.lit(FOUND), F.lit(1))


def _fold(names: Column) -> Column:
    sequence = F.array_join(F.transform(names, lambda n: F.concat(F.lit(","), n, F.lit(","))), "")
    rules = F.array(*[F.struct(F.lit(rule_key(ids)).alias("run"), F.lit(name).alias("name")) for ids, name in RULES])
    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(acc, rule):
        hit = F.contains(acc["left"], rule["run"])
        return F.when(hit, F.struct(F.replace(acc["left"], rule["run"], F.lit(",#,")).alias("left"), F.array_append(acc["found"], rule["name"]).alias("found"))).otherwise(acc)

    return F.array_join(F.array_distinct(F.aggregate(rules, start, step)["found"]), ",")


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, licenses (comma-joined), sentence_ids (comma-joined, in order), n_unknown."""
    known = F.create_map(*[F.lit(x) for pair in identifiers().items() for x in pair])
    named = lambda s: F.coalesce(F.try_element_at(known, s), F.try_element_at(known, F.regexp_replace(s, PHRASE, "under ")))
    may = F.coalesce(F.col(text).rlike(WORDS), F.lit(False))
    found = F.when(may, sentences(F.col(text))).otherwise(F.array().cast("array<string>"))
    entries = let(found, lambda all_: F.transform(all_, lambda s: F.struct(named(F.translate(s, "|", " ")).alias("name"), (s.rlike(HINT) & s.rlike(ABOUT)).alias("about"))))

    def row(e):
        names = F.transform(F.filter(e, lambda x: x["name"].isNotNull()), lambda x: x["name"])
        return F.struct(
            let(names, _fold).alias("licenses"),
            F.array_join(names, ",").alias("sentence_ids"),
            F.size(F.filter(e, lambda x: x["name"].isNull() & x["about"])).cast("long").alias("n_unknown"),
        )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.inline(F.transform(F.array(entries), row)))
