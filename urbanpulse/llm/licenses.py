"""License scans by sentence rules, in DataFrame functions only.

1. A text is cut into sentences: at line breaks and after . ! ? ; (a line that goes
   on in lower case is first joined to the one before).
2. Sentences that hold one of ``KEYWORDS`` are normalised: lower case, comment marks
   and quotes dropped, white space collapsed, "licence" spelt "license".  Every
   sentence rule holds a keyword, so no other sentence can match.
3. Each normalised sentence becomes the identifier of the first sentence rule that
   matches the whole of it; a version or code in the sentence becomes part of the
   identifier.  A sentence without a rule becomes ``?``.
4. Ordered licence rules are matched against the identifier sequence: long forms
   before references.  What a rule has matched is taken out of the sequence.

Rows are independent: no shuffle, no broadcast, one scan.  Nulls and empty texts
have no sentences.  Repeated rows are judged alike.  An empty table gives an empty
result.  Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

KEYWORDS = "licen[sc]e|copyright|spdx|warrant|redistribut|permission|public domain|merchantab|liable|neither the name"

# Normalised sentences of public licences and the identifiers of this
# scanner.  A group in the pattern is the part that the identifier takes over.
_ART = "(?:the |an? )?"
_THIS = "(?:this (?:work|file|program|software|project|library|code|document|package)(?: and its documentation)? |it )?(?:is |are )?"
_UNDER = "(?:under|under the terms of|subject to|subject to the terms of) "
SENTENCES = [
    ("SPDX:", "spdx-license-identifier: ?([a-z0-9.+-]+)"),
    ("COPYRIGHT", "(?:portions )?copyright .*|\\(c\\) ?copyright .*"),
    ("RIGHTS", "all rights reserved"),
    ("APACHE:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}apache license,? ?(?:version |v)?([0-9.]+)(?: \\(the license\\))?"),
    ("APACHE-NOTICE", "you may not use this (?:file|work|software) except in compliance with the license"),
    ("APACHE-COPY", "you may obtain a copy of the license at.*"),
    ("APACHE-URL", "<?https?://www\\.apache\\.org/licenses/.*"),
    ("APACHE-AS-IS", "unless required by applicable law or agreed to in writing,? software distributed under the license is distributed on an as is basis,? without warranties or conditions of any kind.*"),
    ("APACHE-SEE", "see the license for the specific language governing permissions and limitations under the license"),
    ("MIT-REF", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:mit|x11|expat) license(?:.*)?"),
    ("MIT-GRANT", "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.*"),
    ("MIT-NOTICE", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("MIT-WARRANTY", "the software is provided as is, without warranty of any kind.*"),
    ("MIT-LIABLE", "in no event shall the authors or copyright holders be liable.*"),
    ("BSD-REF:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:(?:bsd )?([234])[- ]clause (?:bsd )?license|(?:new |modified |simplified )?bsd license)"),
    ("BSD-GRANT", "redistribution and use in source and binary forms,? with or without modification,? are permitted.*"),
    ("BSD-SOURCE", "(?:[0-9.)]+ )?redistributions of source code must retain the above copyright notice.*"),
    ("BSD-BINARY", "(?:[0-9.)]+ )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSD-NAME", "(?:[0-9.)]+ )?neither the name.*(?:without specific prior written permission)?"),
    ("BSD-WARRANTY", "this software is provided by the .*as is.* warrant.*"),
    ("BSD-LIABLE", "in no event shall the .* be liable .*"),
    ("AGPL:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:gnu )?affero (?:gnu )?general public license,? ?(?:version |v)?([0-9.]*)"),
    ("LGPL:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:gnu )?(?:lesser|library) general public license,? ?(?:version |v)?([0-9.]*)"),
    ("GPL:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:gnu )?general public license,? ?(?:version |v)?([0-9.]*)"),
    ("GPL-LATER:", "you can redistribute it and/or modify it under the terms of the gnu general public license.*version ([0-9.]+) of the license, or .*later version"),
    ("GPL-ONLY:", "you can redistribute it and/or modify it under the terms of the gnu general public license.*version ([0-9.]+)(?: of the license)?"),
    ("GPL-HOPE", ".*without any warranty.*"),
    ("GPL-SEE", "see the gnu general public license for more details"),
    ("GPL-COPY", "you should have received a copy of the gnu general public license.*"),
    ("MPL:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided|subject to|{_UNDER}) ?(?:{_UNDER})?(?:the terms of )?{_ART}mozilla public license,? ?(?:version |v\\. ?|v)?([0-9.]+)"),
    ("CC:", f"{_THIS}(?:licensed|released|distributed|available|made available|provided) {_UNDER}{_ART}(?:cc|creative commons)[ -]((?:by|cc0|zero)(?:-(?:sa|nc|nd))* ?[0-9.]*)(?: (?:international|unported))?(?: license)?"),
    ("PUBLIC", f"{_THIS}(?:in|released (?:in)?to|placed in(?:to)?|dedicated to) the public domain"),
    ("PROPRIETARY", "(?:this (?:file|document|software) is )?proprietary and confidential.*|unauthorized copying .* is strictly prohibited.*"),
    ("ASK", "(?:please )?see (?:the )?licen[sc]e(?:\\.txt|\\.md)?(?: file)?(?: for (?:more )?details)?"),
]

# Ordered licence rules over the sequence "<id><id>...": (licence, pattern).
_APACHE_REST = "(?:<APACHE-NOTICE>|<APACHE-COPY>|<APACHE-URL>|<APACHE-AS-IS>|<APACHE-SEE>)"
_BSD_REST = "(?:<BSD-WARRANTY>)?(?:<BSD-LIABLE>|<MIT-LIABLE>)?"
_GPL_REST = "(?:<GPL-HOPE>)?(?:<GPL-SEE>)?(?:<GPL-COPY>)?"
RULES = [
    ("Apache-2.0", f"<APACHE:2(?:\\.0)?>{_APACHE_REST}+"),
    ("Apache-2.0", f"{_APACHE_REST}{{2,}}"),
    ("BSD-3-Clause", f"<BSD-GRANT><BSD-SOURCE><BSD-BINARY><BSD-NAME>{_BSD_REST}"),
    ("BSD-2-Clause", f"<BSD-GRANT><BSD-SOURCE><BSD-BINARY>{_BSD_REST}"),
    ("MIT", "<MIT-GRANT>(?:<MIT-NOTICE>)?(?:<MIT-WARRANTY>)?(?:<MIT-LIABLE>)?"),
    ("GPL-3.0-or-later", f"<GPL-LATER:3(?:\\.0)?>{_GPL_REST}"),
    ("GPL-2.0-or-later", f"<GPL-LATER:2(?:\\.0)?>{_GPL_REST}"),
    ("GPL-3.0-only", f"<GPL-ONLY:3(?:\\.0)?>{_GPL_REST}"),
    ("GPL-2.0-only", f"<GPL-ONLY:2(?:\\.0)?>{_GPL_REST}"),
    ("Apache-2.0", "<APACHE:2(?:\\.0)?>"),
    ("Apache-1.1", "<APACHE:1\\.1>"),
    ("MIT", "<MIT-REF>"),
    ("BSD-3-Clause", "<BSD-REF:3>"),
    ("BSD-2-Clause", "<BSD-REF:2>"),
    ("BSD", "<BSD-REF:[^>]*>"),
    ("AGPL-3.0", "<AGPL:3(?:\\.0)?>"),
    ("LGPL-3.0", "<LGPL:3(?:\\.0)?>"),
    ("LGPL-2.1", "<LGPL:2\\.1>"),
    ("GPL-3.0", "<GPL:3(?:\\.0)?>"),
    ("GPL-2.0", "<GPL:2(?:\\.0)?>"),
    ("GPL", "<(?:GPL|GPL-LATER|GPL-ONLY):[^>]*>"),
    ("LGPL", "<LGPL:[^>]*>"),
    ("AGPL", "<AGPL:[^>]*>"),
    ("MPL-2.0", "<MPL:2\\.0>"),
    ("CC-BY-NC-4.0", "<CC:by-nc 4\\.0>"),
    ("CC-BY-SA-4.0", "<CC:by-sa 4\\.0>"),
    ("CC-BY-4.0", "<CC:by 4\\.0>"),
    ("CC", "<CC:[^>]*>"),
    ("SPDX", "<SPDX:[^>]*>"),
    ("Public-Domain", "<PUBLIC>"),
    ("Proprietary", "<PROPRIETARY>"),
    ("All-Rights-Reserved", "(?:<COPYRIGHT>)?<RIGHTS>"),
    ("See-File", "<ASK>"),
]

BREAKS = "\r\x0b\x0c\x85  "
JOIN_LINE = r"([^.!?:;\n])\n[ \t]*([a-z(])"
END_SENTENCE = r"([.!?;])[ \t]+"
MARKS = r"[\"'`*]+|^[ \t/#;>-]+|[ \t.!?;,/]+$"


def sentences(text: Column) -> Column:
    """Normalised sentences of the text that hold a keyword, in order."""
    plain = F.translate(text, BREAKS, " " * len(BREAKS))
    joined = F.regexp_replace(plain, JOIN_LINE, "$1 $2")
    parts = F.split(F.regexp_replace(joined, END_SENTENCE, "$1\n"), "\n")
    told = F.filter(parts, lambda s: F.lower(s).rlike(KEYWORDS))
    return F.transform(told, lambda s: F.regexp_replace(F.trim(F.regexp_replace(
        F.regexp_replace(F.lower(s), MARKS, ""), r"[ \t]+", " ")), "licence", "license"))


def identify(sentence: Column) -> Column:
    """Identifier of a normalised sentence; ``?`` without a rule."""
    out = F
    for name, pattern in SENTENCES:
        whole = f"^(?:{pattern})$"
        value = F.concat(F.lit(name), F.regexp_extract(sentence, whole, 1)) if name.endswith(":") else F.lit(name)
        out = out.when(sentence.rlike(whole), value)
    return out.otherwise(F.lit("?"))


def match_rules(sequence: Column) -> Column:
    """Licences of an identifier sequence, each once, in the order of ``RULES``."""
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(p).alias("pattern")) for n, p in RULES))
    none = F.array().cast("array<string>")
    start = F.struct(F.array_join(F.transform(sequence, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
                     .alias("rest"), none.alias("found"))

    def step(acc: Column, rule: Column) -> Column:
        hit = F.rlike(acc["rest"], rule["pattern"])
        return F.struct(
            F.when(hit, F.regexp_replace(acc["rest"], rule["pattern"], F.lit("|"))).otherwise(acc["rest"]).alias("rest"),
            F.when(hit & ~F.array_contains(acc["found"], rule["name"]), F.array_append(acc["found"], rule["name"]))
            .otherwise(acc["found"]).alias("found"))

    return F.when(F.size(sequence) > 0, F.aggregate(rules, start, step, lambda a: a["found"])).otherwise(none)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids`` and ``licenses`` (arrays of strings); such columns are replaced."""
    text = whole_text(text_col)
    none = F.array().cast("array<string>")
    # a text without a keyword has no sentence to look at
    ids = F.when(F.lower(text).rlike(KEYWORDS), F.transform(sentences(text), identify)).otherwise(none)
    return docs.withColumn("sentence_ids", ids).withColumn("licenses", match_rules(F.col("sentence_ids")))
