"""Public license texts and notices that are scanned for (fixed values).

Each entry: label, words of the text, key phrases. Words are in lower case without
punctuation, as scans see them. Statements have one or two key phrases, which must all
stand in a file; whole texts have more, of which half must, so that a few changed words
don't hide a text.
"""

from __future__ import annotations

STATEMENTS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at http www apache org licenses license 2 0", ("compliance with the license", "apache org")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ("permission is hereby granted", "free of charge")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ("redistribution and use", "source and binary forms")),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2",
     ("general public license version 2",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     ("general public license version 3",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation",
     ("free software", "general public license")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ("with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work",
     ("waived all copyright",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
    ("epl-2.0", "made available under the terms of the eclipse public license v 2 0", ("eclipse public license",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
)

_BSD_CONDITIONS = """redistribution and use in source and binary forms with or without modification are permitted
provided that the following conditions are met redistributions of source code must retain the above copyright notice
this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright
notice this list of conditions and the following disclaimer in the documentation and or other materials provided with
the distribution"""
_BSD_NAME = """neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission"""
_BSD_DISCLAIMER = """this software is provided by the copyright holders and contributors as is and any express or implied
warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose
are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental
special exemplary or consequential damages including but not limited to procurement of substitute goods or services
loss of use data or profits or business interruption however caused and on any theory of liability whether in contract
strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if
advised of the possibility of such damage"""
_BSD_KEYS = ("redistribution and use", "source and binary forms", "above copyright notice", "following disclaimer",
             "express or implied warranties", "possibility of such damage")

WHOLE_TEXTS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit-text", """permission is hereby granted free of charge to any person obtaining a copy of this software and
associated documentation files the software to deal in the software without restriction including without limitation
the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and
this permission notice shall be included in all copies or substantial portions of the software the software is provided
as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for
any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
connection with the software or the use or other dealings in the software""",
     ("permission is hereby granted", "free of charge", "deal in the software", "permission notice shall be included",
      "without warranty of any kind", "authors or copyright holders", "other dealings in the software")),
    ("bsd-2-clause", f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}", _BSD_KEYS),
    ("bsd-3-clause", f"{_BSD_CONDITIONS} {_BSD_NAME} {_BSD_DISCLAIMER}", (
        *_BSD_KEYS, "endorse or promote products", "neither the name")),
    ("isc-text", """permission to use copy modify and or distribute this software for any purpose with or without fee is
hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is
provided as is and the author disclaims all warranties with regard to this software including all implied warranties of
merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential
damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence
or other tortious action arising out of or in connection with the use or performance of this software""",
     ("with or without fee", "appear in all copies", "author disclaims all warranties", "other tortious action")),
    ("zlib", """this software is provided as is without any express or implied warranty in no event will the authors be held
liable for any damages arising from the use of this software permission is granted to anyone to use this software for any
purpose including commercial applications and to alter it and redistribute it freely subject to the following
restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original
software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is
not required altered source versions must be plainly marked as such and must not be misrepresented as being the original
software this notice may not be removed or altered from any source distribution""",
     ("authors be held liable", "permission is granted to anyone", "must not be misrepresented",
      "altered source versions", "removed or altered")),
    ("unlicense-text", """this is free and unencumbered software released into the public domain anyone is free to copy
modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any
purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or
authors of this software dedicate any and all copyright interest in the software to the public domain we make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law the software is provided as is without warranty of any kind""",
     ("unencumbered software", "public domain anyone is free", "recognize copyright laws", "heirs and successors",
      "relinquishment in perpetuity")),
    ("bsl-1.0-text", """permission is hereby granted free of charge to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license the software to use reproduce display distribute execute
and transmit the software and to prepare derivative works of the software and to permit third parties to whom the
software is furnished to do so all subject to the following the copyright notices in the software and this entire
statement including the above license grant this restriction and the following disclaimer must be included in all copies
of the software in whole or in part and all derivative works of the software unless such copies or derivative works are
solely in the form of machine executable object code generated by a source language processor""",
     ("person or organization obtaining", "execute and transmit", "third parties to whom", "machine executable object code",
      "source language processor")),
    ("apache-2.0-notice", """licensed under the apache license version 2 0 the license you may not use this file except in
compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless
required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
without warranties or conditions of any kind either express or implied see the license for the specific language governing
permissions and limitations under the license""",
     ("apache license", "compliance with the license", "required by applicable law", "specific language governing")),
    ("gpl-notice", """this program is free software you can redistribute it and or modify it under the terms of the gnu
general public license as published by the free software foundation either version 2 of the license or at your option any
later version this program is distributed in the hope that it will be useful but without any warranty without even the
implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more
details""",
     ("free software foundation", "general public license", "hope that it will be useful", "without even the implied warranty")),
    ("mpl-2.0-notice", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the
mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0""",
     ("mozilla public license", "mozilla org mpl")),
)

TEMPLATES = STATEMENTS + WHOLE_TEXTS
