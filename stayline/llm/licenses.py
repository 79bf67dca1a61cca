"""Templates of usual licenses: standard notices, their common wordings and passages of their bodies.

A wording that is part of another one stands for both. Passages that several versions or licenses
share carry the name of the family (BSD, CC, EPL, GPL, LGPL). Notices of versions that differ in a
number are cut so that the number decides: with another one, less than 0.8 of the shingles remain.
"""

from __future__ import annotations

#: Names that are no SPDX identifiers.
_OTHER = {"BSD", "CC", "EPL", "GPL", "LGPL", "Proprietary"}

#: By license. ``SPDX-License-Identifier: NAME`` is added for every SPDX identifier.
WORDINGS: dict[str, tuple[str, ...]] = {
    "0BSD": ("Zero-Clause BSD", "BSD Zero Clause License"),
    "AGPL-3.0": (
        "GNU Affero General Public License, version 3", "GNU Affero General Public License v3",
        "GNU Affero General Public License 3", "GNU AGPL version 3", "AGPL version 3", "AGPLv3", "AGPL v3", "AGPL-3.0",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Apache License, Version 2.0", "Apache License 2.0",
        "Apache License v2", "Apache 2.0 License", "Apache 2 License", "Apache-2.0 licensed", "License: Apache-2.0",
        "Apache Software License 2.0", "Apache Software License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
        "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",
    ),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic License, Version 2.0"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        'AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY '
        'AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED',
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
        "under the BSD License", "under a BSD-style license", "BSD licensed",
    ),
    "BSD-2-Clause": ("BSD 2-Clause", "2-Clause BSD", "Two-Clause BSD", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": (
        "BSD 3-Clause", "3-Clause BSD", "Three-Clause BSD", "New BSD License", "Modified BSD License", "Revised BSD License",
        "nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission",
    ),
    "BSL-1.0": (
        "Boost Software License 1.0", "Boost Software License, Version 1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        "execute, and transmit the Software",
    ),
    "CC": (
        "Subject to the terms and conditions of this Public License, the Licensor hereby grants You a worldwide, "
        "royalty-free, non-sublicensable, non-exclusive, irrevocable license to exercise the Licensed Rights in the "
        "Licensed Material",
        "under a Creative Commons license",
    ),
    "CC0-1.0": (
        "CC0", "Creative Commons Zero", "publicdomain/zero/1.0",
        "waived all copyright and related or neighboring rights to",
    ),
    "EPL": ('THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT")',),
    "EPL-1.0": ("Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License - v 1.0",
                "Eclipse Public License, Version 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0",
                "Eclipse Public License, Version 2.0"),
    "GPL": ("under the GPL", "under the terms of the GNU General Public License", "under the GNU GPL", "GPL licensed"),
    "GPL-2.0": (
        "GNU General Public License, version 2", "GNU General Public License v2", "GNU General Public License 2",
        "GNU GPL version 2", "GPL version 2", "GPLv2", "GPL v2", "GPL-2.0",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 "
        "of the License",
        "guarantee your freedom to share and change free software--to make sure the software is free for all its users",
        "You may copy and distribute verbatim copies of the Program's source code as you receive it",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License, version 3", "GNU General Public License v3", "GNU General Public License 3",
        "GNU GPL version 3", "GPL version 3", "GPLv3", "GPL v3", "GPL-3.0",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License",
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all "
        "versions of a program",
    ),
    "ISC": (
        "ISC License", "ISC licensed", "License: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "LGPL": ("under the LGPL", "under the terms of the GNU Lesser General Public License", "under the GNU LGPL"),
    "LGPL-2.1": (
        "GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1",
        "GNU Lesser General Public License 2.1", "LGPL version 2.1", "LGPLv2.1", "LGPL v2.1", "LGPL-2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License",
        "You may copy and distribute verbatim copies of the Library's complete source code as you receive it",
    ),
    "LGPL-3.0": (
        "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3",
        "GNU Lesser General Public License 3", "LGPL version 3", "LGPLv3", "LGPL v3", "LGPL-3.0",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
        "GNU General Public License",
    ),
    "MIT": (
        "Released under the MIT License.", "MIT License", "MIT licensed", "License: MIT", "MIT/X11 License", "under the MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    ),
    "MPL-2.0": (
        "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0",
        "Mozilla Public License v2.0", "MPL 2.0", "MPLv2", "MPL v2",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license under intellectual property "
        "rights (other than patent or trademark) Licensable by such Contributor to use, reproduce, make available, "
        "modify, display, perform, distribute, and otherwise exploit its Contributions",
    ),
    "Proprietary": (
        "All rights reserved.", "proprietary and confidential",
        "Unauthorized copying of this file, via any medium, is strictly prohibited",
    ),
    "Unlicense": (
        "The Unlicense", "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "WTFPL": ("WTFPL", "Do What The Fuck You Want To Public License"),
    "Zlib": (
        "zlib License", "zlib/libpng License",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
    ),
}

_CREATIVE_COMMONS = {
    "BY": ("Attribution",),
    "BY-SA": ("Attribution-ShareAlike", "Attribution-Share Alike"),
    "BY-NC": ("Attribution-NonCommercial", "Attribution-Non-Commercial"),
    "BY-ND": ("Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivatives"),
    "BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "Attribution-Non-Commercial-Share Alike"),
    "BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs"),
}


def _creative_commons() -> dict[str, tuple[str, ...]]:
    made = {}
    for kind, titles in _CREATIVE_COMMONS.items():
        for version in ("2.0", "2.5", "3.0", "4.0"):
            made[f"CC-{kind}-{version}"] = (
                f"Licensed under CC {kind} {version}.", f"CC {kind} {version}", f"licenses/{kind.lower()}/{version}",
                *(f"Creative Commons {t} {version}" for t in titles))
    return made


#: Pairs (license, template).
LICENSES: tuple[tuple[str, str], ...] = tuple(
    (name, text) for name, texts in sorted({**WORDINGS, **_creative_commons()}.items())
    for text in (*texts, *([] if name in _OTHER else [f"SPDX-License-Identifier: {name}"])))
