"""Licence notices, standard headers and whole texts that the licence scan looks for.

Each has a label, its words, and the key phrases that must stand in a file. The version
of a licence is part of a key phrase, so one version is never taken for another.
"""

# Label, notice or standard header, and the phrases it must hold.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["apache org licenses license 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution", "source", "binary forms", "conditions"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike 4 0"]),
    ("cc0-1.0", "to the extent possible under law the author has dedicated all copyright to the public domain cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("gpl-2.0", "this program is free software you can redistribute it under the terms of the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", ["permission", "hereby granted", "without fee"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["hereby granted free", "obtaining", "associated documentation files"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", ["mozilla public license v 2 0"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license v 2 0"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at", ["eclipse public license 2 0"]),
]

# Licences whose versions share one wording: label, name, versions.
VERSIONED = [
    ("agpl", "gnu affero general public license", ["1", "3"]),
    ("gpl", "gnu general public license", ["1", "2", "3"]),
    ("lgpl", "gnu lesser general public license", ["2 1", "3"]),
]
VERSION_NOTICE = "licensed under the {name} version {version}"
VERSION_HEADER = (
    "is free software you can redistribute it and or modify it under the terms of the {name} as published by "
    "the free software foundation either version {version} of the license or at your option any later version"
)

# Licences named by a machine-readable line.
SPDX = (
    "0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 "
    "GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense Zlib"
).split()
SPDX_LINE = "spdx license identifier {words}"

# Whole texts, lower-cased and without punctuation, and their key phrases.
_MIT = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated
documentation files the software to deal in the software without restriction including without limitation the
rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
and this permission notice shall be included in all copies or substantial portions of the software the software is
provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
arising from out of or in connection with the software or the use or other dealings in the software
"""
_BSD_CONDITIONS = """
redistribution and use in source and binary forms with or without modification are permitted provided that the
following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
this list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution
"""
_BSD_ENDORSEMENT = """
3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission
"""
_BSD_DISCLAIMER = """
this software is provided by the copyright holders and contributors as is and any express or implied warranties
including but not limited to the implied warranties of merchantability and fitness for a particular purpose are
disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services
loss of use data or profits or business interruption however caused and on any theory of liability whether in
contract strict liability or tort including negligence or otherwise arising in any way out of the use of this
software even if advised of the possibility of such damage
"""
_ISC = """
permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies the software is provided as
is and the author disclaims all warranties with regard to this software including all implied warranties of
merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract
negligence or other tortious action arising out of or in connection with the use or performance of this software
"""
_ZLIB = """
this software is provided as is without any express or implied warranty in no event will the authors be held liable
for any damages arising from the use of this software permission is granted to anyone to use this software for any
purpose including commercial applications and to alter it and redistribute it freely subject to the following
restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original
software if you use this software in a product an acknowledgment in the product documentation would be appreciated
but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being
the original software 3 this notice may not be removed or altered from any source distribution
"""
_UNLICENSE = """
this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
compile sell or distribute this software either in source code form or as a compiled binary for any purpose
commercial or non commercial and by any means
"""
WHOLE_TEXTS = [
    ("mit", _MIT, ["hereby granted free", "without restriction", "substantial portions", "noninfringement"]),
    ("bsd-2-clause", _BSD_CONDITIONS + _BSD_DISCLAIMER, ["binary forms", "distribution this software is provided"]),
    ("bsd-3-clause", _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER, ["binary forms", "endorse or promote products"]),
    ("isc", _ISC, ["without fee", "hereby granted provided", "tortious action"]),
    ("zlib", _ZLIB, ["alter it and redistribute", "misrepresented", "plainly marked"]),
    ("unlicense", _UNLICENSE, ["free and unencumbered software"]),
]


def licences() -> list[tuple[str, str, list[str]]]:
    """All of the above as label, words and key phrases."""
    found = list(NOTICES)
    for family, name, versions in VERSIONED:
        for version in versions:
            label = f"{family}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            words = {"name": name, "version": version}
            found.append((label, VERSION_NOTICE.format(**words), [f"{name} version {version}"]))
            keys = [f"{name} as published by", f"version {version} of the license"]
            found.append((label, VERSION_HEADER.format(**words), keys))
    for name in SPDX:
        line = SPDX_LINE.format(words=name.lower().replace("-", " ").replace(".", " "))
        found.append((name.lower(), line, [line]))
    return found + [(label, " ".join(text.split()), keys) for label, text, keys in WHOLE_TEXTS]
