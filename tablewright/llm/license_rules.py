"""The signature rules of the license scan: hand-written patterns of license families, each
expanded to the forms in which licenses are named.

Patterns are matched on text with A-Z in lower case. ``{s}`` stands for what may lie between
two words. All quantifiers are bounded, so that a match has a bounded length.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str    # a literal that every match contains, without a blank where the pattern has {s}
    pattern: str


SPDX, GRANT, NAME, TEXT = 4, 3, 2, 1
#: How sure a detection of a priority is.
WEIGHT = {SPDX: 1.0, GRANT: 0.9, NAME: 0.7, TEXT: 0.5}

#: Blanks and commas, or the end of a line with the comment marks that begin the next one.
_S = r"(?:[ \t]{0,2},?\r?\n[ \t*#/;%!-]{1,12}|[\s,]{1,6})"
_V = r"(?:" + _S + r"|-)(?:version" + _S + r"|v\.?\s?)?"

# (label, keyword, SPDX identifiers, name)
FAMILIES = [
    ("mit", "mit", r"mit", r"\bmit{s}licen[cs]e\b"),
    ("mit-0", "mit", r"mit-0", r"\bmit{s}no{s}attribution\b"),
    ("x11", "x11", r"x11", r"\bx11{s}licen[cs]e\b"),
    ("isc", "isc", r"isc", r"\bisc{s}licen[cs]e\b"),
    ("zlib", "zlib", r"zlib", r"\bzlib(?:/libpng)?{s}licen[cs]e\b"),
    ("unlicense", "unlicense", r"unlicense", r"\bthe{s}unlicense\b"),
    ("wtfpl", "wtfpl", r"wtfpl", r"\bwtfpl\b"),
    ("wtfpl", "want", r"wtfpl", r"\bdo{s}what{s}the{s}f\S{{1,6}}{s}you{s}want\b"),
    ("beerware", "beer", r"beerware", r"\bbeer-?ware{s}licen[cs]e\b"),
    ("0bsd", "bsd", r"0bsd", r"\bzero-?{s}?clause{s}bsd\b"),
    ("bsd-2-clause", "bsd", r"bsd-2-clause(?:-[a-z]{{2,12}})?", r"\b(?:bsd[\s-]2-clause|2-clause{s}bsd|simplified{s}bsd)(?:{s}licen[cs]e)?\b"),
    ("bsd-3-clause", "bsd", r"bsd-3-clause(?:-[a-z]{{2,12}})?", r"\b(?:bsd[\s-]3-clause|3-clause{s}bsd|(?:new|modified|revised){s}bsd)(?:{s}licen[cs]e)?\b"),
    ("bsd-4-clause", "bsd", r"bsd-4-clause", r"\b(?:bsd[\s-]4-clause|4-clause{s}bsd|original{s}bsd)(?:{s}licen[cs]e)?\b"),
    ("bsd", "bsd", r"bsd", r"\bbsd{s}(?:style{s}|type{s})?licen[cs]e\b"),
    ("apache-1.1", "apache", r"apache-1\.[01]", r"\bapache{s}(?:software{s})?licen[cs]e{v}1\.[01]\b"),
    ("apache-2.0", "apache", r"apache-2\.0", r"\bapache{s}(?:software{s})?licen[cs]e{v}2(?:\.0)?\b"),
    ("apache", "apache", r"apache", r"\bapache{s}(?:software{s})?licen[cs]e\b"),
    ("gpl-1.0", "general", r"gpl-1\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?general{s}public{s}licen[cs]e{v}1\b"),
    ("gpl-2.0", "general", r"gpl-2\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?general{s}public{s}licen[cs]e{v}2(?:\.0)?\b"),
    ("gpl-3.0", "general", r"gpl-3\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?general{s}public{s}licen[cs]e{v}3(?:\.0)?\b"),
    ("gpl", "general", r"gpl", r"\b(?:gnu{s})?general{s}public{s}licen[cs]e\b"),
    ("gpl-short", "gpl", r"gplv[123]", r"\b(?:gnu{s})?gpl(?:{s}?v[123])?{s}licen[cs]ed?\b"),
    ("lgpl-2.0", "general", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?library{s}general{s}public{s}licen[cs]e{v}2(?:\.0)?\b"),
    ("lgpl-2.1", "general", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?lesser{s}general{s}public{s}licen[cs]e{v}2\.1\b"),
    ("lgpl-3.0", "general", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?lesser{s}general{s}public{s}licen[cs]e{v}3(?:\.0)?\b"),
    ("lgpl", "general", r"lgpl", r"\b(?:gnu{s})?(?:lesser|library){s}general{s}public{s}licen[cs]e\b"),
    ("agpl-1.0", "general", r"agpl-1\.0", r"\baffero{s}general{s}public{s}licen[cs]e{v}1(?:\.0)?\b"),
    ("agpl-3.0", "general", r"agpl-3\.0(?:-only|-or-later|\+)?", r"\b(?:gnu{s})?affero{s}general{s}public{s}licen[cs]e{v}3(?:\.0)?\b"),
    ("agpl", "general", r"agpl", r"\b(?:gnu{s})?affero{s}general{s}public{s}licen[cs]e\b"),
    ("gfdl", "documentation", r"gfdl-1\.[123](?:-only|-or-later)?", r"\b(?:gnu{s})?free{s}documentation{s}licen[cs]e\b"),
    ("mpl-1.1", "mozilla", r"mpl-1\.[01]", r"\bmozilla{s}public{s}licen[cs]e{v}1\.[01]\b"),
    ("mpl-2.0", "mozilla", r"mpl-2\.0", r"\bmozilla{s}public{s}licen[cs]e{v}2(?:\.0)?\b"),
    ("mpl", "mozilla", r"mpl", r"\bmozilla{s}public{s}licen[cs]e\b"),
    ("epl-1.0", "eclipse", r"epl-1\.0", r"\beclipse{s}public{s}licen[cs]e{v}1(?:\.0)?\b"),
    ("epl-2.0", "eclipse", r"epl-2\.0", r"\beclipse{s}public{s}licen[cs]e{v}2(?:\.0)?\b"),
    ("edl-1.0", "eclipse", r"edl-1\.0", r"\beclipse{s}distribution{s}licen[cs]e\b"),
    ("cddl-1.0", "distribution", r"cddl-1\.0", r"\bcommon{s}development{s}and{s}distribution{s}licen[cs]e\b"),
    ("cpl-1.0", "common", r"cpl-1\.0", r"\bcommon{s}public{s}licen[cs]e\b"),
    ("cpal-1.0", "attribution", r"cpal-1\.0", r"\bcommon{s}public{s}attribution{s}licen[cs]e\b"),
    ("ipl-1.0", "ibm", r"ipl-1\.0", r"\bibm{s}public{s}licen[cs]e\b"),
    ("apsl-2.0", "apple", r"apsl-[12]\.\d", r"\bapple{s}public{s}source{s}licen[cs]e\b"),
    ("artistic-1.0", "artistic", r"artistic-1\.0(?:-perl)?", r"\bartistic{s}licen[cs]e{v}1(?:\.0)?\b"),
    ("artistic-2.0", "artistic", r"artistic-2\.0", r"\bartistic{s}licen[cs]e{v}2(?:\.0)?\b"),
    ("artistic", "artistic", r"artistic", r"\bartistic{s}licen[cs]e\b"),
    ("afl-3.0", "academic", r"afl-[123]\.\d", r"\bacademic{s}free{s}licen[cs]e\b"),
    ("osl-3.0", "software", r"osl-[123]\.\d", r"\bopen{s}software{s}licen[cs]e\b"),
    ("ofl-1.1", "font", r"ofl-1\.[01](?:-no-rfn|-rfn)?", r"\b(?:sil{s})?open{s}font{s}licen[cs]e\b"),
    ("eupl-1.2", "european", r"eupl-1\.[012]", r"\beuropean{s}union{s}public{s}licen[cs]e\b"),
    ("cecill", "cecill", r"cecill-\d\.\d", r"\bcecill(?:-[bc])?{s}licen[cs]e\b"),
    ("bsl-1.0", "boost", r"bsl-1\.0", r"\bboost{s}software{s}licen[cs]e\b"),
    ("busl-1.1", "business", r"busl-1\.1", r"\bbusiness{s}source{s}licen[cs]e\b"),
    ("sspl-1.0", "server", r"sspl-1\.0", r"\bserver{s}side{s}public{s}licen[cs]e\b"),
    ("elastic-2.0", "elastic", r"elastic-2\.0", r"\belastic{s}licen[cs]e\b"),
    ("ms-pl", "microsoft", r"ms-pl", r"\bmicrosoft{s}public{s}licen[cs]e\b"),
    ("ms-rl", "microsoft", r"ms-rl", r"\bmicrosoft{s}reciprocal{s}licen[cs]e\b"),
    ("python-2.0", "python", r"(?:psf|python)-2\.0", r"\bpython{s}(?:software{s}foundation{s})?licen[cs]e\b"),
    ("ruby", "ruby", r"ruby", r"\bruby{s}licen[cs]e\b"),
    ("php-3.01", "php", r"php-3\.0\d?", r"\bphp{s}licen[cs]e\b"),
    ("postgresql", "postgresql", r"postgresql", r"\bpostgresql{s}licen[cs]e\b"),
    ("openssl", "openssl", r"openssl", r"\bopenssl{s}licen[cs]e\b"),
    ("ncsa", "illinois", r"ncsa", r"\buniversity{s}of{s}illinois(?:/ncsa)?{s}open{s}source{s}licen[cs]e\b"),
    ("upl-1.0", "universal", r"upl-1\.0", r"\buniversal{s}permissive{s}licen[cs]e\b"),
    ("vim", "vim", r"vim", r"\bvim{s}licen[cs]e\b"),
    ("w3c", "w3c", r"w3c", r"\bw3c{s}(?:software{s})?(?:notice{s}and{s})?licen[cs]e\b"),
    ("odbl-1.0", "database", r"odbl-1\.0", r"\bopen{s}(?:data{s}commons{s}open{s})?database{s}licen[cs]e\b"),
    ("odc-by-1.0", "commons", r"odc-by-1\.0", r"\bopen{s}data{s}commons{s}attribution{s}licen[cs]e\b"),
    ("pddl-1.0", "dedication", r"pddl-1\.0", r"\bpublic{s}domain{s}dedication{s}and{s}licen[cs]e\b"),
    ("cc0-1.0", "cc0", r"cc0-1\.0", r"\bcc0(?:{s}1\.0)?(?:{s}universal)?\b"),
    ("cc-by-nc-nd", "by-nc-nd", r"cc-by-nc-nd-\d\.\d", r"\bcc[\s-]by-nc-nd(?:[\s-]\d\.\d)?\b"),
    ("cc-by-nc-sa", "by-nc-sa", r"cc-by-nc-sa-\d\.\d", r"\bcc[\s-]by-nc-sa(?:[\s-]\d\.\d)?\b"),
    ("cc-by-nc", "by-nc", r"cc-by-nc-\d\.\d", r"\bcc[\s-]by-nc(?:[\s-]\d\.\d)?\b"),
    ("cc-by-nd", "by-nd", r"cc-by-nd-\d\.\d", r"\bcc[\s-]by-nd(?:[\s-]\d\.\d)?\b"),
    ("cc-by-sa", "by-sa", r"cc-by-sa-\d\.\d", r"\bcc[\s-]by-sa(?:[\s-]\d\.\d)?\b"),
    ("cc-by", "by", r"cc-by-\d\.\d", r"\bcc[\s-]by(?:[\s-]\d\.\d)?\b"),
    ("creative-commons", "commons", r"cc", r"\bcreative{s}commons{s}(?:[a-z-]{{2,16}}{s}){{0,4}}licen[cs]e\b"),
]

# (label, keyword, pattern): addresses of licenses
ADDRESSES = [
    ("mit", "opensource.org", r"opensource\.org/licen[cs]es?/mit\b"),
    ("isc", "opensource.org", r"opensource\.org/licen[cs]es?/isc\b"),
    ("bsd", "opensource.org", r"opensource\.org/licen[cs]es?/bsd[a-z0-9-]{0,20}"),
    ("apache-2.0", "apache.org", r"apache\.org/licen[cs]es/license-2\.0"),
    ("gpl", "gnu.org", r"gnu\.org/licen[cs]es/(?:old-licenses/)?gpl[a-z0-9.-]{0,16}"),
    ("lgpl", "gnu.org", r"gnu\.org/licen[cs]es/(?:old-licenses/)?lgpl[a-z0-9.-]{0,16}"),
    ("agpl", "gnu.org", r"gnu\.org/licen[cs]es/agpl[a-z0-9.-]{0,16}"),
    ("gfdl", "gnu.org", r"gnu\.org/licen[cs]es/fdl[a-z0-9.-]{0,16}"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-2.0", "eclipse.org", r"eclipse\.org/legal/epl[a-z0-9.-]{0,8}"),
    ("cc0-1.0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", "creativecommons.org", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("creative-commons", "creativecommons.org", r"creativecommons\.org/licen[cs]es/[a-z-]{2,8}/\d\.\d"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
]

# (label, keyword, pattern): sentences of license texts and notices
SENTENCES = [
    ("mit", "hereby", r"permission{s}is{s}hereby{s}granted,?{s}free{s}of{s}charge"),
    ("isc", "and/or", r"permission{s}to{s}use,{s}copy,{s}modify,{s}and/or{s}distribute{s}this{s}software"),
    ("zlib", "altered", r"altered{s}source{s}versions{s}must{s}be{s}plainly{s}marked"),
    ("bsd", "redistribution", r"redistribution{s}and{s}use{s}in{s}source{s}and{s}binary{s}forms"),
    ("bsd-3-clause", "endorse", r"to{s}endorse{s}or{s}promote{s}products{s}derived{s}from{s}this{s}software"),
    ("bsd-4-clause", "advertising", r"all{s}advertising{s}materials{s}mentioning{s}features"),
    ("apache-2.0", "compliance", r"not{s}use{s}this{s}file{s}except{s}in{s}compliance{s}with{s}the{s}license"),
    ("apache-2.0", "governing", r"for{s}the{s}specific{s}language{s}governing{s}permissions{s}and{s}limitations"),
    ("mpl-2.0", "mozilla", r"source{s}code{s}form{s}is{s}subject{s}to{s}the{s}terms{s}of{s}the{s}mozilla{s}public{s}license"),
    ("bsl-1.0", "machine-executable", r"machine-executable{s}object{s}code{s}generated{s}by{s}a{s}source{s}language"),
    ("unlicense", "unencumbered", r"free{s}and{s}unencumbered{s}software{s}released{s}into{s}the{s}public{s}domain"),
    ("no-warranty", "warrant", r"(?:provided|distributed){s}\"?as(?:-|{s})is\"?,?{s}without{s}(?:any{s})?warrant(?:y|ies)"),
    ("no-warranty", "warranty", r"without{s}any{s}warranty;{s}without{s}even{s}the{s}implied{s}warranty"),
    ("no-warranty", "liable", r"in{s}no{s}event{s}shall{s}the{s}(?:authors?|copyright{s}(?:holders?|owners?))"
                              r"(?:{s}or{s}(?:copyright{s}holders?|contributors))?{s}be{s}liable"),
    ("gpl", "foundation", r"as{s}published{s}by{s}the{s}free{s}software{s}foundation"),
    ("public-domain", "domain", r"\b(?:dedicated{s}to|released{s}into|in|into){s}the{s}public{s}domain\b"),
    ("copyright", "copyright", r"\bcopyright{s}(?:\(c\)|©)?\s?(?:19|20)\d\d"),
    ("all-rights-reserved", "reserved", r"\ball{s}rights{s}reserved\b"),
    ("proprietary", "proprietary", r"\bproprietary{s}(?:and{s}confidential|license)\b"),
    ("copyleft", "copyleft", r"\bcopyleft\b"),
]

_GRANTED = (r"\b(?:licen[cs]ed|released|distributed|available|published|provided){s}"
            r"(?:to{s}you{s})?under{s}(?:an?{s}|the{s})?(?:terms{s}of{s}(?:an?{s}|the{s})?)?"
            r"(?:gnu{s})?")


def rules() -> list[Rule]:
    """All rules, in the order in which they win among equal detections."""
    found = []
    for label, keyword, spdx, name in FAMILIES:
        name = name.format(s=_S, v=_V)
        found.append(Rule(label, SPDX, "spdx",
                          r"spdx-license-identifier:\s{0,4}\(?" + spdx.format() + r"(?![a-z0-9.+-])"))
        found.append(Rule(label, GRANT, keyword, _GRANTED.format(s=_S) + name))
        found.append(Rule(label, NAME, keyword, name))
    found += [Rule(label, GRANT, keyword, pattern) for label, keyword, pattern in ADDRESSES]
    found += [Rule(label, TEXT, keyword, pattern.format(s=_S)) for label, keyword, pattern in SENTENCES]
    return found
