"""Licence templates: public notices and the operative paragraphs of short licences.

Fixed values: the wording must be that of the licences. Copyright lines are not part of a
template, as normalising drops them.
"""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""

BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""

BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written
permission."""

BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
OF SUCH DAMAGE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations under
the License."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation, either
version {0} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
General Public License for more details."""

#: With the name of the licence, what it covers and its version.
FSF_NOTICE = """This {1} is free software: you can redistribute it and/or modify it under the
terms of the GNU {0} as published by the Free Software Foundation, either
version {2} of the License, or (at your option) any later version.

This {1} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
{0} for more details."""
AFFERO = "Affero General Public License"
LESSER = "Lesser General Public License"

GPL_ONLY_NOTICE = """This program is free software; you can redistribute it and/or modify it under
the terms of the GNU General Public License version {0} as published by the Free Software
Foundation."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""

#: Operative paragraphs of licence texts that are too long to be compared as a whole.
APACHE_GRANT = """Grant of Copyright License. Subject to the terms and conditions of this License, each
Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free,
irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display,
publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or
Object form."""

GPL2_GRANT = """You may copy and distribute verbatim copies of the Program's source code as you receive it, in
any medium, provided that you conspicuously and appropriately publish on each copy an
appropriate copyright notice and disclaimer of warranty; keep intact all the notices that refer
to this License and to the absence of any warranty; and give any other recipients of the Program
a copy of this License along with the Program."""

GPL3_GRANT = """Notwithstanding any other provision of this License, you have permission to link or combine any
covered work with a work licensed under version 3 of the GNU Affero General Public License into
a single combined work, and to convey the resulting work. The terms of this License will
continue to apply to the part which is the covered work, but the special requirements of the GNU
Affero General Public License, section 13, concerning interaction through a network will apply
to the combination as such."""

LGPL21_GRANT = """You may copy and distribute verbatim copies of the Library's complete source code as you receive
it, in any medium, provided that you conspicuously and appropriately publish on each copy an
appropriate copyright notice and disclaimer of warranty; keep intact all the notices that refer
to this License and to the absence of any warranty; and distribute a copy of this License along
with the Library."""

LGPL3_GRANT = """This version of the GNU Lesser General Public License incorporates the terms and conditions of
version 3 of the GNU General Public License, supplemented by the additional permissions listed
below."""

MPL_GRANT = """Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: (a) under
intellectual property rights (other than patent or trademark) Licensable by such Contributor to
use, reproduce, make available, modify, display, perform, distribute, and otherwise exploit its
Contributions, either on an unmodified basis, with Modifications, or as part of a Larger Work;
and (b) under Patent Claims of such Contributor to make, use, sell, offer for sale, have made,
import, and otherwise transfer either its Contributions or its Contributor Version."""

CC0_WAIVER = """To the greatest extent permitted by, but not in contravention of, applicable law, Affirmer
hereby overtly, fully, permanently, irrevocably and unconditionally waives, abandons, and
surrenders all of Affirmer's Copyright and Related Rights and associated claims and causes of
action, whether now known or unknown (including existing as well as future claims and causes of
action), in the Work (i) in all territories worldwide, (ii) for the maximum duration provided by
applicable law or treaty (including future time extensions), (iii) in any current or future
medium and for any number of copies, and (iv) for any purpose whatsoever, including without
limitation commercial, advertising or promotional purposes (the "Waiver")."""

AGPL_GRANT = """Notwithstanding any other provision of this License, if you modify the Program, your
modified version must prominently offer all users interacting with it remotely through a computer
network (if your version supports such interaction) an opportunity to receive the Corresponding
Source of your version by providing access to the Corresponding Source from a network server at no
charge, through some standard or customary means of facilitating copying of software."""

UNLICENSE_GRANT = """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""

#: Name of the licence and the wordings by which it is recognised.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("ISC", ISC),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-2-Clause", BSD_TWO),
    ("BSD-2-Clause", BSD_TWO + "\n" + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_TWO + "\n" + BSD_THIRD),
    ("BSD-3-Clause", BSD_TWO + "\n" + BSD_THIRD + "\n" + BSD_WARRANTY),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", GPL_NOTICE.format(2)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", GPL_NOTICE.format(3)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All rights reserved", "All rights reserved."),
    ("AGPL-3.0", FSF_NOTICE.format(AFFERO, "program", 3)),
    ("LGPL-2.1", FSF_NOTICE.format(LESSER, "library", 2.1)),
    ("LGPL-2.1", FSF_NOTICE.format(LESSER, "program", 2.1)),
    ("LGPL-2.0", FSF_NOTICE.format("Library General Public License", "library", 2)),
    ("LGPL-3.0", FSF_NOTICE.format(LESSER, "library", 3)),
    ("LGPL-3.0", FSF_NOTICE.format(LESSER, "program", 3)),
    ("GPL-2.0", GPL_ONLY_NOTICE.format(2)),
    ("GPL-3.0", GPL_ONLY_NOTICE.format(3)),
    ("MPL-2.0", MPL_NOTICE),
    ("Apache-2.0", APACHE_GRANT),
    ("GPL-2.0", GPL2_GRANT),
    ("GPL-3.0", GPL3_GRANT),
    ("AGPL-3.0", AGPL_GRANT),
    ("LGPL-2.1", LGPL21_GRANT),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", LGPL3_GRANT),
    ("MPL-2.0", MPL_GRANT),
    ("CC0-1.0", CC0_WAIVER),
    ("Unlicense", UNLICENSE_GRANT),
]
