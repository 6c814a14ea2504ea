"""Texts and notices of public licenses that ``licenses`` looks for.

A phrase in braces tells a license from its relatives (a version, a clause):
a match must hold each such phrase.
"""

from __future__ import annotations

# Wording of public licenses, (license, text).
TEXTS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, {provided that} the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, {provided that} the above copyright notice and this permission notice appear in all copies"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is {hereby granted. THE SOFTWARE} IS PROVIDED \"AS IS\""),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the {distribution. THIS SOFTWARE} IS PROVIDED BY"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the {copyright holder nor} the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Apache-2.0", "Licensed under the Apache License, {Version 2.0} (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License {Version 2.0}, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either {version 2} of the License, or (at your option) any later version."),
    ("GPL-2.0", "it under the terms of the GNU General Public License {version 2} as published by the Free Software Foundation"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE {Version 2, June} 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("GPL-3.0", "it under the terms of the GNU General Public License {version 3} as published by the Free Software Foundation"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE {Version 3}, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either {version 2.1} of the License, or (at your option) any later version."),
    ("LGPL-3.0", "modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("AGPL-3.0", "modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either {version 3} of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, {v. 2.0}. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License {2.0} which is available at"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

# How a license is named, (license, name).
NAMES = [
    ("MIT", "the {MIT License}"),
    ("ISC", "the {ISC License}"),
    ("BSD-2-Clause", "the {BSD 2-Clause} License"),
    ("BSD-3-Clause", "the {BSD 3-Clause} License"),
    ("Apache-2.0", "the Apache License, {Version 2.0}"),
    ("Apache-2.0", "the {Apache License 2.0}"),
    ("Apache-2.0", "the {Apache 2.0} License"),
    ("GPL-2.0", "the GNU General Public License, {version 2}"),
    ("GPL-2.0", "the GNU General Public License {v2.0}"),
    ("GPL-2.0", "the {GNU GPL v2}"),
    ("GPL-3.0", "the GNU General Public License, {version 3}"),
    ("GPL-3.0", "the GNU General Public License {v3.0}"),
    ("GPL-3.0", "the {GNU GPL v3}"),
    ("LGPL-2.1", "the GNU Lesser General Public License, {version 2.1}"),
    ("LGPL-3.0", "the GNU Lesser General Public License, {version 3}"),
    ("AGPL-3.0", "the GNU Affero General Public License, {version 3}"),
    ("MPL-2.0", "the Mozilla Public License, {version 2.0}"),
    ("MPL-2.0", "the Mozilla Public License {2.0}"),
    ("EPL-2.0", "the Eclipse Public License {2.0}"),
    ("CC0-1.0", "{CC0 1.0} Universal"),
]
VERBS = ["licensed under", "released under", "distributed under", "available under", "under the terms of"]
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}


def cc_names() -> list[tuple[str, str]]:
    """Short and long names of the Creative Commons licenses."""
    out = []
    for kind in CC_KINDS:
        for version, suffix in CC_VERSIONS.items():
            parts = "-".join(CC_PARTS[p] for p in kind.split("-"))
            major = version.split(".")[0]  # phrases are five words at most
            out += [(f"CC-{kind}-{version}", f"{{CC {kind} {major}}}.0"), (f"CC-{kind}-{version}", f"a Creative {{Commons {parts} {major}}}.0 {suffix} License")]
    return out


def templates() -> list[tuple[str, str]]:
    """(license, text with its telling phrases in braces) of all texts and notices."""
    return TEXTS + [(name, f"{verb} {words}") for name, words in NAMES + cc_names() for verb in VERBS]
