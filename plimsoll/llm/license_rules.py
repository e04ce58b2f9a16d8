"""Signature rules for licences, as data.

A rule is (label, tier, first words, pattern). The pattern is matched against lower-cased words
joined by single spaces, starting at one of the first words; tiers say how much a match proves:
3 for grant and notice texts and SPDX tags, 2 for a name with version or in a grant phrase, 1 for a
name, 0 for a hint. Earlier rules win ties.
"""

from __future__ import annotations

#: Phrases every scan reports, whatever else overlaps them.
BASE = [("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"),
        ("mit", "mit license")]

#: label; names as patterns; versions as patterns ("" for a licence without); SPDX stem.
FAMILIES = [
    ("gpl", ["gnu gpl", "gnu general public licen[sc]e", "general public licen[sc]e"], "[123](?: 0)?", "gpl"),
    ("lgpl", ["gnu lgpl", "gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e",
              "lesser general public licen[sc]e"], "[23](?: [01])?", "lgpl"),
    ("agpl", ["gnu agpl", "gnu affero general public licen[sc]e", "affero general public licen[sc]e"],
     "[13](?: 0)?", "agpl"),
    ("gfdl", ["gnu fdl", "gnu free documentation licen[sc]e", "free documentation licen[sc]e"], "1(?: [123])?", "gfdl"),
    ("apache", ["apache software licen[sc]e", "apache licen[sc]e", "asl"], "[12](?: [01])?", "apache"),
    ("mit", ["mit licen[sc]e", "mit x11 licen[sc]e", "expat licen[sc]e"], "", "mit"),
    ("x11", ["x11 licen[sc]e", "x consortium licen[sc]e"], "", "x11"),
    ("bsd", ["bsd licen[sc]e", "bsd [234] clause licen[sc]e", "berkeley software distribution licen[sc]e",
             "(?:new|modified|simplified|revised|original) bsd licen[sc]e"], "", "bsd [0234] clause"),
    ("isc", ["isc licen[sc]e", "internet systems consortium licen[sc]e"], "", "isc"),
    ("mpl", ["mozilla public licen[sc]e"], "[12](?: [01])?", "mpl"),
    ("epl", ["eclipse public licen[sc]e"], "[12](?: 0)?", "epl"),
    ("edl", ["eclipse distribution licen[sc]e"], "1(?: 0)?", "edl"),
    ("cddl", ["common development and distribution licen[sc]e"], "1(?: [01])?", "cddl"),
    ("cpl", ["common public licen[sc]e"], "1(?: 0)?", "cpl"),
    ("ipl", ["ibm public licen[sc]e"], "1(?: 0)?", "ipl"),
    ("eupl", ["european union public licen[sc]e"], "1(?: [012])?", "eupl"),
    ("osl", ["open software licen[sc]e"], "[123](?: [01])?", "osl"),
    ("afl", ["academic free licen[sc]e"], "[123](?: [012])?", "afl"),
    ("artistic", ["artistic licen[sc]e", "clarified artistic licen[sc]e"], "[12](?: 0)?", "artistic"),
    ("bsl", ["boost software licen[sc]e"], "1(?: 0)?", "bsl"),
    ("busl", ["business source licen[sc]e"], "1(?: 1)?", "busl"),
    ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"], "", "zlib"),
    ("libpng", ["libpng licen[sc]e", "png reference library licen[sc]e"], "[2](?: 0)?", "libpng"),
    ("psf", ["python software foundation licen[sc]e", "psf licen[sc]e"], "2(?: 0)?", "psf"),
    ("ruby", ["ruby licen[sc]e"], "", "ruby"),
    ("php", ["php licen[sc]e"], "3(?: 0[01]?)?", "php"),
    ("openssl", ["openssl licen[sc]e", "ssleay licen[sc]e"], "", "openssl"),
    ("unlicense", ["unlicense", "the unlicense"], "", "unlicense"),
    ("wtfpl", ["do what the fuck you want to public licen[sc]e", "wtfpl"], "2", "wtfpl"),
    ("cc0", ["cc0", "creative commons zero", "creative commons cc0"], "1(?: 0)?", "cc0"),
    ("cc-by", ["cc by", "creative commons attribution"], "[1234](?: [05])?", "cc by"),
    ("cc-by-sa", ["cc by sa", "creative commons attribution share ?alike"], "[1234](?: [05])?", "cc by sa"),
    ("cc-by-nc", ["cc by nc", "creative commons attribution non ?commercial"], "[1234](?: [05])?", "cc by nc"),
    ("cc-by-nd", ["cc by nd", "creative commons attribution no ?deriv(?:ative)?s"], "[1234](?: [05])?", "cc by nd"),
    ("cc-by-nc-sa", ["cc by nc sa", "creative commons attribution non ?commercial share ?alike"],
     "[1234](?: [05])?", "cc by nc sa"),
    ("cc-by-nc-nd", ["cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s"],
     "[1234](?: [05])?", "cc by nc nd"),
    ("odbl", ["open database licen[sc]e", "open data commons open database licen[sc]e"], "1(?: 0)?", "odbl"),
    ("odc-by", ["open data commons attribution licen[sc]e"], "1(?: 0)?", "odc by"),
    ("pddl", ["open data commons public domain dedication"], "1(?: 0)?", "pddl"),
    ("ofl", ["sil open font licen[sc]e", "open font licen[sc]e"], "1(?: [01])?", "ofl"),
    ("lppl", ["latex project public licen[sc]e"], "1(?: [0123][abc]?)?", "lppl"),
    ("ms-pl", ["microsoft public licen[sc]e"], "", "ms pl"),
    ("ms-rl", ["microsoft reciprocal licen[sc]e"], "", "ms rl"),
    ("ncsa", ["university of illinois ncsa open source licen[sc]e"], "", "ncsa"),
    ("postgresql", ["postgresql licen[sc]e"], "", "postgresql"),
    ("qpl", ["q public licen[sc]e"], "1(?: 0)?", "qpl"),
    ("sleepycat", ["sleepycat licen[sc]e"], "", "sleepycat"),
    ("sspl", ["server side public licen[sc]e"], "1(?: 0)?", "sspl"),
    ("vim", ["vim licen[sc]e"], "", "vim"),
    ("w3c", ["w3c software notice and licen[sc]e", "w3c licen[sc]e"], "", "w3c"),
    ("zpl", ["zope public licen[sc]e"], "[12](?: [01])?", "zpl"),
    ("curl", ["curl licen[sc]e"], "", "curl"),
    ("elastic", ["elastic licen[sc]e"], "2(?: 0)?", "elastic"),
    ("upl", ["universal permissive licen[sc]e"], "1(?: 0)?", "upl"),
    ("blueoak", ["blue oak model licen[sc]e"], "1(?: 0)?(?: 0)?", "blueoak"),
    ("cecill", ["cecill licen[sc]e", "cecill free software licen[sc]e"], "[12](?: [01])?", "cecill"),
]

#: Notices and abbreviations that follow no common shape.
NOTICES = [
    ("mit", 3, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", 3, "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("isc", 3, "permission to use copy modify and distribute this software for any purpose with or without fee"),
    ("bsd", 3, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 3, "redistributions of source code must retain the above copyright notice"),
    ("bsd", 3, "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", 3, "neither the name of (?:\\S+ ){1,8}nor the names of its contributors may be used"),
    ("apache", 3, "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", 3, "you may not use this file except in compliance with the license"),
    ("gpl", 3, "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("gpl", 3, "this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", 3, "this library is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("gfdl", 3, "permission is granted to copy distribute and or modify this document under the terms of the gnu"),
    ("mpl", 3, "this source code form is subject to the terms of the mozilla public license"),
    ("epl", 3, "this program and the accompanying materials are made available under the terms of the eclipse"),
    ("zlib", 3, "this software is provided as is without any express or implied warranty in no event will the authors"),
    ("bsl", 3, "distributed under the boost software license"),
    ("unlicense", 3, "this is free and unencumbered software released into the public domain"),
    ("cc0", 3, "to the extent possible under law (?:\\S+ ){1,8}has waived all copyright"),
    ("cc-by", 3, "this work is licensed under (?:a|the) creative commons attribution"),
    ("ofl", 3, "this font software is licensed under the sil open font license"),
    ("psf", 3, "this license agreement is between the python software foundation"),
    ("proprietary", 3, "this software is confidential and proprietary"),
    ("proprietary", 2, "unauthorized (?:copying|use|distribution) of this (?:file|software)"),
    ("proprietary", 2, "all rights reserved"),
    ("public-domain", 2, "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", 1, "public domain dedication"),
    ("gpl", 2, "gplv[123](?: or later)?"), ("gpl", 2, "gpl v? ?[123](?: 0)?(?: (?:only|or later))?"),
    ("lgpl", 2, "lgplv[23](?: [01])?(?: or later)?"), ("lgpl", 2, "lgpl v? ?[23](?: [01])?(?: (?:only|or later))?"),
    ("agpl", 2, "agplv3(?: or later)?"), ("agpl", 2, "agpl v? ?3(?: 0)?(?: (?:only|or later))?"),
    ("gpl", 0, "gpl"), ("lgpl", 0, "lgpl"), ("agpl", 0, "agpl"), ("mpl", 2, "mpl [12] [01]"), ("epl", 2, "epl [12] 0"),
    ("cddl", 0, "cddl"), ("eupl", 0, "eupl"), ("odbl", 0, "odbl"), ("sspl", 0, "sspl"), ("cecill", 0, "cecill"),
    ("cc0", 0, "cc zero"), ("apache", 2, "apache 2 0"), ("copyleft", 0, "copyleft"),
]

LEAD = "(?:licensed|released|distributed|available|provided|published|covered|governed)"
GRANT = LEAD + " (?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:a |an |the )?"


def signatures() -> list[tuple[str, int, str, bool]]:
    """(label, tier, pattern, base) in order: base phrases, notices, then each family's forms."""
    rules = [(label, 1, phrase, True) for label, phrase in BASE]
    rules += [(label, tier, pattern, False) for label, tier, pattern in NOTICES]
    for label, names, version, stem in FAMILIES:
        numbered = f"(?: v| version)? {version}" if version else ""
        rules.append((label, 3, f"spdx license identifier {stem}" + (f"(?: {version})?" if version else "")
                      + "(?: (?:only|or later))?", False))
        for name in names:
            rules.append((label, 2, GRANT + name + (f"(?:{numbered})?" if version else ""), False))
            if version:
                rules.append((label, 2, name + numbered + "(?: (?:only|or (?:any )?later(?: version)?))?", False))
            rules.append((label, 1, name, False))
    return rules
