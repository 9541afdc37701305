"""Licence recognition by sentences: normal forms of sentences have identifiers, rules are sequences of identifiers.

Signs of comments are taken off and wrapped lines are joined; the text is cut into sentences. Those that use a word of
licences are brought to a normal form (lower case, one blank between words, version numbers and names of holders as
slots) and joined with the table of known sentences. The
identifiers of a document, in order, are then matched against the rules; the first rule that fits takes its sentences
away, so a longer licence is named before a shorter one that it contains.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Words without which a sentence has nothing to do with a licence.
KEYS = ("licen", "copyright", "rights reserved", "permission", "warrant", "redistribut", "public domain", "spdx", "cc by", "cc0", "free software", "creative commons", "as is", "as-is", "liable")

# Known sentences in their normal form, by identifier. <v> is a version, <who> a holder.
SENTENCES = {
    "copyright": ["copyright <who>"],
    "reserved": ["all rights reserved"],
    "apache-ref": ["licensed under the apache license, version <v>", "licensed under the apache license version <v>", "licensed under apache license <v>", 'licensed under the apache license, version <v> (the "license")', "released under the apache license, version <v>"],
    "apache-comply": ["you may not use this file except in compliance with the license"],
    "apache-obtain": ["you may obtain a copy of the license at <url>", "you may obtain a copy of the license at"],
    "apache-asis": ['unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an "as is" basis, without warranties or conditions of any kind, either express or implied'],
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license"],
    "mit-grant": ['permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "software"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions:'],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit-asis": ['the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement'],
    "mit-liable": ["in no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"],
    "isc-asis": ['the software is provided "as is" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness'],
    "isc-grant": ["permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "bsd-ref": ["released under the bsd license", "licensed under the bsd license"],
    "bsd-intro": ["redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of <who> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-asis": [
        'this software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed',
        'this software is provided by the author "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed',
    ],
    "zlib-asis": ["this software is provided 'as-is', without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-ref": ["distributed under the boost software license, version <v>"],
    "boost-grant": ['permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "software") to use, reproduce, display, distribute, execute, and transmit the software, and to prepare derivative works of the software, and to permit third-parties to whom the software is furnished to do so, all subject to the following:'],
    "epl-ref": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license <v> which accompanies this distribution, and is available at <url>",
        "this program and the accompanying materials are made available under the terms of the eclipse public license <v> which is available at <url>",
        "licensed under the eclipse public license, version <v>",
    ],
    "lgpl-later": [
        "this library is free software; you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation; either version <v> of the license, or (at your option) any later version",
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation, either version <v> of the license, or (at your option) any later version",
    ],
    "agpl-later": ["this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version <v> of the license, or (at your option) any later version"],
    "gpl-only": [
        "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license version <v> as published by the free software foundation",
        "this program is free software; you can redistribute it and/or modify it under the terms of version <v> of the gnu general public license as published by the free software foundation",
    ],
    "gpl-see": ["see the gnu general public license for more details", "see the gnu lesser general public license for more details", "see the gnu affero general public license for more details"],
    "gpl-copy": ["you should have received a copy of the gnu general public license along with this program", "you should have received a copy of the gnu lesser general public license along with this library", "you should have received a copy of the gnu affero general public license along with this program"],
    "gpl-ref": ["this work is licensed under the gnu general public license, version <v>", "licensed under the gnu general public license, version <v>", "licensed under the gnu general public license version <v>", "licensed under the gpl, version <v>"],
    "gpl-later": ["this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version <v> of the license, or (at your option) any later version", "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation; either version <v> of the license, or (at your option) any later version"],
    "gpl-hope": ["this library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose", "this program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose"],
    "lgpl-ref": ["licensed under the gnu lesser general public license, version <v>", "this work is licensed under the gnu lesser general public license, version <v>"],
    "agpl-ref": ["licensed under the gnu affero general public license, version <v>", "this work is licensed under the gnu affero general public license, version <v>"],
    "mpl-ref": ["this source code form is subject to the terms of the mozilla public license, v. <v>", "licensed under the mozilla public license, version <v>"],
    "cc-by": ["licensed under cc by <v>", "this work is licensed under a creative commons attribution <v> international license"],
    "cc-by-sa": ["licensed under cc by-sa <v>", "this work is licensed under a creative commons attribution-sharealike <v> international license"],
    "cc-by-nc": ["licensed under cc by-nc <v>", "this work is licensed under a creative commons attribution-noncommercial <v> international license"],
    "cc-by-nd": ["licensed under cc by-nd <v>"],
    "cc-by-nc-sa": ["licensed under cc by-nc-sa <v>"],
    "cc-by-nc-nd": ["licensed under cc by-nc-nd <v>"],
    "cc0": ["licensed under cc0 <v>", "released under cc0 <v>"],
    "public-domain": ["this is free and unencumbered software released into the public domain", "this work is in the public domain", "released into the public domain"],
    "spdx": ["spdx-license-identifier: <spdx>"],
}

# Rules in the order in which they are tried. {v} is the version of the sentence before it.
RULES = [
    (("boost-grant",), "BSL-1.0"),
    (("mit-grant", "mit-notice", "mit-asis", "mit-liable"), "MIT"),
    (("mit-grant", "mit-notice", "mit-asis"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("isc-grant", "isc-asis"), "ISC"),
    (("isc-grant",), "ISC"),
    (("zlib-asis", "zlib-grant"), "Zlib"),
    (("bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-asis"), "BSD-3-Clause"),
    (("bsd-intro", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-intro", "bsd-source", "bsd-binary", "bsd-asis"), "BSD-2-Clause"),
    (("bsd-intro", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("apache-ref", "apache-comply", "apache-obtain", "apache-asis"), "Apache-{v}"),
    (("apache-ref",), "Apache-{v}"),
    (("agpl-later", "gpl-hope", "gpl-see", "gpl-copy"), "AGPL-{v}-or-later"),
    (("lgpl-later", "gpl-hope", "gpl-see", "gpl-copy"), "LGPL-{v}-or-later"),
    (("gpl-later", "gpl-hope", "gpl-see", "gpl-copy"), "GPL-{v}-or-later"),
    (("agpl-later",), "AGPL-{v}-or-later"),
    (("lgpl-later",), "LGPL-{v}-or-later"),
    (("gpl-only", "gpl-hope", "gpl-see", "gpl-copy"), "GPL-{v}-only"),
    (("gpl-only",), "GPL-{v}-only"),
    (("gpl-later", "gpl-hope"), "GPL-{v}-or-later"),
    (("gpl-later",), "GPL-{v}-or-later"),
    (("gpl-ref",), "GPL-{v}"),
    (("lgpl-ref",), "LGPL-{v}"),
    (("agpl-ref",), "AGPL-{v}"),
    (("mpl-ref",), "MPL-{v}"),
    (("epl-ref",), "EPL-{v}"),
    (("boost-ref",), "BSL-{v}"),
    (("mit-ref",), "MIT"),
    (("bsd-ref",), "BSD"),
    (("cc-by-nc-sa",), "CC-BY-NC-SA-{v}"),
    (("cc-by-nc-nd",), "CC-BY-NC-ND-{v}"),
    (("cc-by-nc",), "CC-BY-NC-{v}"),
    (("cc-by-nd",), "CC-BY-ND-{v}"),
    (("cc-by-sa",), "CC-BY-SA-{v}"),
    (("cc-by",), "CC-BY-{v}"),
    (("cc0",), "CC0-{v}"),
    (("public-domain",), "Public-Domain"),
    (("spdx",), "{v}"),
    (("copyright", "reserved"), "All-Rights-Reserved"),
    (("reserved",), "All-Rights-Reserved"),
]

#: Signs of comments before and behind a line; an item's number or bullet.
_LEADER = re.compile(r"[ \t]*(?:/\*+!?|\*+/?|//+!?|#+|;+|-->|--+|<!--|%+|\"{3}|'{3}|REM\b|dnl\b)?[ \t]*")
_TRAILER = re.compile(r"[ \t]*(?:\*+/|-->|\"{3}|'{3})?[ \t\r]*$")
_ITEM = re.compile(r"(?:\(?(?:[0-9]{1,2}|[a-h])[.)]|[-*•])[ \t]+")
#: A line that begins so begins a sentence.
_STARTS = re.compile(r"(?:Copyright|COPYRIGHT|SPDX-|Licensed|Released|Distributed|Permission|Redistribution|This (?:work|program|library|software|file|project|is|source)|The above|THE SOFTWARE|THIS SOFTWARE|All rights|Unless|You (?:may|should)|Neither|See the)")
_END = re.compile(r"[.!?](?=\s|$)|(?<=\));(?=\s)|:(?=\n)|\n+")
_COMMENT = re.compile(r"^[\s*#/\-;\"'0-9).(]*(?=[^\W\d])")
_SPDX = re.compile(r"(spdx-license-identifier:)\s*(\S+)")
_VERSION = re.compile(r"(?<=[ v])v?([0-9]+(?:\.[0-9]+)*)(?![\w])")
_NAME = re.compile(r"(?<=neither the name of ).+?(?= nor the names of)")
_URL = re.compile(r"https?://\S+")


def unwrapped(text: str) -> tuple[str, list[int], list[int]]:
    """The text without signs of comments, wrapped lines joined by a blank, and where each of its parts lies in both texts.

    A line break stays only where a line is empty, is an item, or begins a sentence of its own.
    """
    parts, new, old, size, at = [], [], [], 0, 0
    for line in text.split("\n"):
        a = _LEADER.match(line).end()
        piece = line[a : max(a, _TRAILER.search(line, a).start())]
        item = _ITEM.match(piece)
        if item:
            a, piece = a + item.end(), piece[item.end() :]
        sign = "\n" if not piece or item or _STARTS.match(piece) else " "
        if size:
            parts.append(sign)
            size += 1
        new.append(size)
        old.append(at + a)
        parts.append(piece)
        size += len(piece)
        at += len(line) + 1
    return "".join(parts), new, old


def sentences(text: str) -> list[tuple[int, int]]:
    """Code point ranges of sentences of an unwrapped text: up to a full stop before a blank, or a line break."""
    out, at = [], 0
    for m in _END.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def normal(sentence: str) -> tuple[str, str | None]:
    """Normal form and the version or SPDX name that it holds."""
    s = _COMMENT.sub("", sentence).lower().replace("“", '"').replace("”", '"')
    s = re.sub(r"\s+", " ", s).strip()
    if m := _SPDX.search(s):
        name = re.search(r"(?i)spdx-license-identifier:\s*(\S+)", sentence).group(1)
        return "spdx-license-identifier: <spdx>", name
    if s.startswith("copyright "):
        return "copyright <who>", None
    s = _NAME.sub("<who>", _URL.sub("<url>", s)).rstrip(" .!?,;")
    found = _VERSION.search(s)
    version = None
    if found:
        version = found.group(1)
        s = s[: found.start()] + "<v>" + s[found.end() :]
    return s, version


def licence_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, seq, start, end, form, version) of every sentence with a word of licences."""

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc", "seq", "start", "end", "form", "version")}
            for k, text in enumerate(batch.column(1).to_pylist()):
                low = (text or "").lower()
                if not any(key in low for key in KEYS):
                    continue
                plain, new, old = unwrapped(text)
                for n, (a, b) in enumerate(sentences(plain)):
                    piece = plain[a:b]
                    if any(key in piece.lower() for key in KEYS):
                        form, version = normal(piece)
                        # First and last sign of the sentence, in the text as it was.
                        x, y = (old[(i := bisect_right(new, at) - 1)] + at - new[i] for at in (a + len(piece) - len(piece.lstrip()), a + len(piece.rstrip()) - 1))
                        for c, v in zip(out, (k, n, x, y + 1, form, version), strict=True):
                            out[c].append(v)
            take = pa.array(out["doc"], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), *(pa.array(out[c], pa.int32()) for c in ("seq", "start", "end")), pa.array(out["form"], pa.string()), pa.array(out["version"], pa.string())], ["doc_id", "row", "seq", "start", "end", "form", "version"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row")).mapInArrow(run, "doc_id long, row long, seq int, start int, end int, form string, version string")


def match_rules(ids: list[str | None], versions: list[str | None]) -> list[tuple[str, int, int]]:
    """(licence, first, last) of the rules that fit, each sentence used once; unknown sentences may stand between."""
    left = [k for k, i in enumerate(ids) if i is not None]
    found = []
    for sequence, name in RULES:
        at = 0
        while at + len(sequence) <= len(left):
            part = left[at : at + len(sequence)]
            if all(ids[k] == want for k, want in zip(part, sequence, strict=True)):
                version = next((versions[k] for k in part if versions[k]), "unknown")
                found.append((name.format(v=version), part[0], part[-1]))
                left = left[:at] + left[at + len(sequence) :]
            else:
                at += 1
    return sorted(found, key=lambda x: x[1:])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, licences (array of struct licence, start, end), n_known, n_unknown.

    n_known and n_unknown count sentences with a word of licences that have, or lack, an identifier. Null and empty
    texts have none; very long ones are read whole. Rows without an id are left out; an id on several rows is returned
    for each, with what its own text holds. Other columns are not read and may have any name. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(i, form) for i, forms in SENTENCES.items() for form in forms], "sid string, form string")
    seen = licence_sentences(docs.where(F.col(id_col).isNotNull()), id_col, text_col).join(F.broadcast(known), "form", "left")
    per = stored(seen.distinct().groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "end", "sid", "version"))).alias("s")), "licence-sentences")

    @F.pandas_udf("array<struct<licence:string,start:int,end:int>>")
    def named(column):
        import pandas as pd

        out = []
        for rows in column:
            got = match_rules([r["sid"] for r in rows], [r["version"] for r in rows])
            out.append([{"licence": n, "start": int(rows[a]["start"]), "end": int(rows[b]["end"])} for n, a, b in got])
        return pd.Series(out)

    per = per.select("doc_id", "row", named("s").alias("licences"), F.size(F.filter("s", lambda x: x["sid"].isNotNull())).cast("long").alias("n_known"), F.size(F.filter("s", lambda x: x["sid"].isNull())).cast("long").alias("n_unknown"))
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("row"))
    none = F.array().cast("array<struct<licence:string,start:int,end:int>>")
    return ids.join(per, ["doc_id", "row"], "left").select("doc_id", F.coalesce("licences", none).alias("licences"), F.coalesce("n_known", F.lit(0)).alias("n_known"), F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"))


def licence_digest(docs: DataFrame) -> DataFrame:
    """doc_id, licences as text (licence:start:end, comma-joined), n_known, n_unknown."""
    joined = F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["licence"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return scan_licenses(docs).select("doc_id", joined.alias("licences"), "n_known", "n_unknown")
