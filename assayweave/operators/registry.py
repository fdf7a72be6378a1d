"""The target registry: how measured targets are named in headers and captions."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """One target: its names, the pattern that names it, the pattern that disqualifies a header."""

    key: str
    name: str
    uniprot: str
    include: str
    exclude: str | None = None
    needs_human: bool = False


# Words that tell a species or an assay that is no enzyme assay.
NON_HUMAN = r"(?i)\b(?:bovine|murine|mouse|rat|porcine|rabbit|canine|dog|monkey|rhesus|cynomolgus|guinea pig|electric eel|Electrophorus|Torpedo|eel|yeast|E\.\s*coli|Plasmodium|bacterial)\b"
HUMAN = r"(?i)\bhuman\b|\bh(?:AChE|BChE|BuChE|CA|EGFR|mTOR|MAO)|\bHomo sapiens\b"
CELL_LINE = r"(?i)\bcells?\b|MCF-?7|HepG-?2|K-?562|A-?549|HeLa|HCT-?116|PC-?3|HT-?29|MDA-MB|Jurkat|HEK|U-?87|\bSK-N|NCI-H|H1975|HL-?60|Caco|LoVo|SW-?480|SW-?620|Panc|THP-?1|GI\s*50|PMNL|whole blood|\bHWB\b"
NOT_POTENCY = r"(?i)\bp(?:IC|K[id])\s?50?|percent|inhibition at|S\.\s?I\.|\bSI\b|selectivity|\bratio\b|\bLE\b|ligand efficiency|fold"
MUTANT = r"(?i)mutant|mutation|T790M|L858R|C797S|del\s?19|\bLR\b|\bTMLR\b|\bTM\b"
BARE_ENDPOINT = r"(?i)IC\s*50|K\s*i\b"
# The tokens a bare endpoint header may consist of.
BARE_TOKENS = (
    r"(?:IC|K)\s*50", r"K\s*i", "values?", "inhibition", r"enzym\w*", "kinase", "mean", "±", r"S\.?E\.?M\.?", r"S\.?D\.?", "[pnmµμu]?M",
    r"\(", r"\)", r"\[", r"\]", ",", ":", "a", "b", "c", r"\*", r"\s", r"\|",
)
NO_CAPTION = r"(?i)\bcell|antiprolif|cytotox|GI\s*50|growth inhibit"
MASS_HEADER = r"(?i)[µμu]g\s*/\s*m[Ll]|mg\s*/\s*m?[Ll]|ng\s*/\s*m[Ll]"
OTHER_SPECIES_HEADER = r"(?i)\b(?:ee|Ee|EE|eq|Eq|EQ|e)(?:AChE|BChE|BuChE)\b|electric eel|equine|horse serum"
HUMAN_HINT = r"\bhuman\b|\bh[A-Z]"

# The registered targets, in registry order.
RULES: tuple[Rule, ...] = (
    Rule("CA2", "Human carbonic anhydrase II", "P00918", r"(?i)\b(?:hCA|CA|carbonic anhydrase)\s*II\b", None, True),
    Rule("MTOR", "mTOR kinase", "P42345", r"(?<![-\w])mTOR(?:C1|C2)?\b", r"(?i)\bp-?mTOR|phospho|/", False),
    Rule("BCLXL", "BCL-xL", "Q07817", r"\bBcl-?x\s*[lL]\b|\bBCL-?XL\b", r"(?i)/|selectiv|ratio", False),
    Rule("SIRT1", "Sirtuin 1 (SIRT1)", "Q96EB6", r"\bSIRT\s?1\b|\bSirt1\b", r"(?i)/|selectiv|ratio|fold|%", False),
    Rule("SIRT2", "Sirtuin 2 (SIRT2)", "Q8IXJ6", r"\bSIRT\s?2\b|\bSirt2\b", r"(?i)/|selectiv|ratio|fold|%", False),
    Rule("BCHE", "Human butyrylcholinesterase", "P06276", r"(?i)(?<![A-Za-z])h?Bu?ChE\b|\bbutyrylcholinesterase\b", r"(?i)\b(?:eq|Eq|e|m|r)Bu?ChE\b|equine|horse|/|selectiv|ratio|AChE", True),
    Rule("MAOB", "Human monoamine oxidase B", "P27338", r"\bh?MAO-?\s?B\b", r"(?i)/|selectiv|ratio|\bSI\b|rat|MAO-?\s?A", True),
    Rule("MAOA", "Human monoamine oxidase A", "P21397", r"\bh?MAO-?\s?A\b", r"(?i)/|selectiv|ratio|\bSI\b|rat|MAO-?\s?B", True),
    Rule("BACE1", "BACE1 (β-secretase)", "P56817", r"(?i)\bBACE-?1\b|β-secretase|beta-secretase", r"(?i)/|selectiv|ratio|BACE-?2|cell", False),
    Rule("GSK3B", "GSK-3β kinase", "P49841", r"(?i)GSK-?3\s?(?:β|b\b|beta)", r"(?i)/|selectiv|ratio", False),
    Rule("PARP1", "PARP1", "P09874", r"\bPARP-?1\b", r"(?i)/|selectiv|ratio|trapp|PARP-?1[0-9]|PAR level", False),
    Rule("HDAC1", "HDAC1", "Q13547", r"\bHDAC-?\s?1\b(?![0-9])", r"(?i)/|selectiv|ratio|\bSI\b", False),
    Rule("HDAC6", "HDAC6", "Q9UBN7", r"\bHDAC-?\s?6\b", r"(?i)/|selectiv|ratio|\bSI\b", False),
    Rule("PI3KA", "PI3Kα (p110α)", "P42336", r"(?i)PI3K\s?-?(?:α|alpha)|p110\s?-?α|PIK3CA", r"(?i)/|selectiv|ratio|H1047|E545|E542|mut", False),
    Rule("JAK2", "JAK2 kinase", "O60674", r"\bJAK-?\s?2\b", r"(?i)/|selectiv|ratio|V617F|mut", False),
    Rule("COX2", "COX-2", "P35354", r"(?i)\bCOX-?\s?2\b|cyclooxygenase-2", r"(?i)/|selectiv|ratio|\bSI\b|ovine|COX-?\s?1|%", False),
    Rule("DPP4", "DPP-4", "P27487", r"\bDPP-?\s?(?:4|IV)\b", r"(?i)/|selectiv|ratio|DPP-?\s?(?:8|9)", False),
    Rule("SIRT3", "Sirtuin 3 (SIRT3)", "Q9NTG7", r"\bSIRT\s?3\b|\bSirt3\b", r"(?i)/|selectiv|ratio|fold|%", False),
    Rule("CD38", "CD38 (NADase)", "P28907", r"\bCD38\b", r"(?i)/|selectiv|ratio", False),
    Rule("PTP1B", "PTP1B phosphatase", "P18031", r"\bPTP-?1B\b|\bPTPN1\b", r"(?i)/|selectiv|ratio|TCPTP", False),
    Rule("NAMPT", "NAMPT", "P43490", r"\bNAMPT\b", r"(?i)/|selectiv|ratio|cell", False),
    Rule("P38A", "p38α MAP kinase", "Q16539", r"(?i)\bp38\s?-?(?:α|alpha|a\b)|\bp38\s?MAPK\b|MAPK14", r"(?i)/|selectiv|ratio|p38\s?-?(?:β|γ|δ)|phospho|p-p38", False),
    Rule("IGF1R", "IGF-1 receptor kinase", "P08069", r"\bIGF-?1R\b|IGF-?IR\b", r"(?i)/|selectiv|ratio|cell|phospho", False),
    Rule("SEH", "Soluble epoxide hydrolase", "P34913", r"(?i)\bh?sEH\b|soluble epoxide hydrolase", r"(?i)/|selectiv|ratio|\bm-?sEH|\br-?sEH|murine|rat", False),
    Rule("ALOX5", "5-lipoxygenase", "P09917", r"(?i)\b5-?LOX\b|\b5-?LO\b|5-lipoxygenase", r"(?i)/|selectiv|ratio|soybean|FLAP|cell", False),
    Rule("PDE4B", "PDE4B", "Q07343", r"\bPDE\s?4B\d?\b", r"(?i)/|selectiv|ratio", False),
    Rule("PDE5", "PDE5", "O76074", r"\bPDE\s?5A?\d?\b", r"(?i)/|selectiv|ratio", False),
    Rule("LSD1", "LSD1 (KDM1A)", "O60341", r"(?i)\bLSD-?1\b|KDM1A", r"(?i)/|selectiv|ratio|cell", False),
    Rule("DYRK1A", "DYRK1A kinase", "Q13627", r"(?i)\bDYRK-?1A\b", r"(?i)/|selectiv|ratio", False),
    Rule("CTSK", "Cathepsin K", "P43235", r"(?i)\bCat(?:hepsin)?\s?-?K\b|\bCTSK\b", r"(?i)/|selectiv|ratio", False),
    Rule("FAAH", "FAAH", "O00519", r"\bh?FAAH\b", r"(?i)/|selectiv|ratio|rat|\brFAAH", False),
    Rule("NNMT", "NNMT", "P40261", r"\bNNMT\b", r"(?i)/|selectiv|ratio|cell", False),
    Rule("HSD11B1", "11β-HSD1", "P28845", r"(?i)11\s?β-?HSD-?1|11β-?HSD1|11b-?HSD-?1|HSD11B1", r"(?i)/|selectiv|ratio|HSD-?2|mouse|murine|rat", False),
    Rule("IDO1", "IDO1", "P14902", r"(?i)\bIDO-?1\b", r"(?i)/|selectiv|ratio|cell|HeLa", False),
    Rule("LRRK2", "LRRK2 kinase", "Q5S007", r"(?i)\bLRRK-?2\b", r"(?i)/|selectiv|ratio|G2019S|mut|pS|cell", False),
    Rule("CDK5", "CDK5 kinase", "Q00535", r"\bCDK-?5\b(?:/p25|/p35)?", r"(?i)selectiv|ratio", False),
    Rule("CSNK1D", "CK1δ kinase", "P48730", r"(?i)\bCK-?1\s?(?:δ|delta|d\b)|CSNK1D", r"(?i)/|selectiv|ratio|CK-?1\s?ε", False),
    Rule("ROCK1", "ROCK1 kinase", "Q13464", r"(?i)\bROCK-?\s?(?:1|I)\b", r"(?i)/|selectiv|ratio", False),
    Rule("ROCK2", "ROCK2 kinase", "O75116", r"(?i)\bROCK-?\s?(?:2|II)\b", r"(?i)/|selectiv|ratio", False),
    Rule("F10", "Factor Xa", "P00742", r"(?i)\bF(?:actor)?\s?-?Xa\b|\bFXa\b", r"(?i)/|selectiv|ratio|rat|rabbit", False),
    Rule("F2", "Thrombin", "P00734", r"(?i)\bthrombin\b|\bFIIa\b", r"(?i)/|selectiv|ratio|time|TT|bovine", False),
    Rule("MMP9", "MMP-9", "P14780", r"(?i)\bMMP-?\s?9\b", r"(?i)/|selectiv|ratio|cell|expression", False),
    Rule("MMP2", "MMP-2", "P08253", r"(?i)\bMMP-?\s?2\b", r"(?i)/|selectiv|ratio|cell|expression", False),
    Rule("ELANE", "Human neutrophil elastase", "P08246", r"(?i)\bHNE\b|neutrophil elastase|\bhNE\b", r"(?i)/|selectiv|ratio|porcine|PPE", False),
    Rule("AKR1B1", "Aldose reductase (ALR2)", "P15121", r"(?i)\bh?ALR-?2\b|aldose reductase|AKR1B1", r"(?i)/|selectiv|ratio|rat|bovine|ALR-?1", True),
    Rule("QPCT", "Glutaminyl cyclase (QC)", "Q16769", r"(?i)\bh?QC\b|glutaminyl cyclase", r"(?i)/|selectiv|ratio|isoQC", False),
    Rule("CDK4", "CDK4 kinase", "P11802", r"\bCDK-?4\b(?:/cyclin\s?D1?)?", r"(?i)selectiv|ratio", False),
    Rule("CDK2", "CDK2 kinase", "P24941", r"\bCDK-?2\b(?:/cyclin\s?[AE]\d?)?", r"(?i)selectiv|ratio", False),
    Rule("TGFBR1", "ALK5 (TGF-β receptor 1)", "P36897", r"(?i)\bALK-?5\b|TGF-?βR-?I\b|TGFBR1", r"(?i)/|selectiv|ratio|cell", False),
    Rule("REN", "Renin", "P00797", r"(?i)\brenin\b", r"(?i)/|selectiv|ratio|plasma|PRA", False),
    Rule("HMGCR", "HMG-CoA reductase", "P04035", r"(?i)HMG-?CoA\s?reductase|\bHMGCR\b|\bHMGR\b", r"(?i)/|selectiv|ratio", False),
    Rule("PDE10A", "PDE10A", "Q9Y233", r"(?i)\bPDE\s?10A?\d?\b", r"(?i)/|selectiv|ratio", False),
    Rule("CASP3", "Caspase-3", "P42574", r"(?i)\bcaspase-?\s?3\b|\bCASP-?3\b", r"(?i)/|selectiv|ratio|cell|activity \(%|fold", False),
    Rule("ACHE", "Human acetylcholinesterase", "P22303", r"(?i)(?<![A-Za-z])h?AChE\b|\bacetylcholinesterase\b", r"(?i)\b(?:ee|Ee|EE|Tc|Dm|m|r)AChE\b|/|selectiv|ratio|BuChE|BChE", True),
    Rule("EGFR", "EGFR kinase (wild type)", "P00533", r"(?<![-\w])EGFR(?:\s*\(?WT\)?|wt)?(?![-\w])", r"(?i)T790M|L858R|C797S|L718Q|G719|del|mut|ex\d|p-?EGFR|phospho|/", False),
)
BY_KEY = {rule.key: rule for rule in RULES}
