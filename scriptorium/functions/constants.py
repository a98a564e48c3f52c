"""Word lists, patterns and limits that results depend on, as text in natural order."""

EXCLUDED_SECTIONS = ["references", "acknowledgment", "acknowledgement", "declaration of use of ai"]
KEPT_BLOCKS = ["Text", "TextInlineMath", "SectionHeader", "ListItem", "ListGroup", "Code", "Equation", "Footnote", "Handwriting"]
SKIPPED_BLOCKS = ["PageHeader", "PageFooter", "Picture", "PictureGroup", "Figure", "FigureGroup", "Caption", "Table", "TableGroup",
                  "TableCell", "TableOfContents", "Form", "Reference"]
BOILERPLATE = [
    r"\bcopyright\b", r"©", r"\bcreative\s+commons\b", r"\bopen\s+access\b", r"\bdistributed\s+under\s+the\s+terms\b",
    r"\bpermits\s+unrestricted\s+use\b", r"\boriginal\s+author\s+and\s+source\s+are\s+credited\b",
    r"\battribution(?:[- ]non[- ]commercial)?\b", r"\binternational\s+license\b", r"\blicense\b", r"\bissn\b", r"\bdoi\b", r"https?://doi\.org/",
]
REFERENCE_START = r"^(?:-+\s*)?(?:[A-Z][A-Za-z'`\-]+,\s+(?:[A-Z]\.\s*)+)"
REFERENCE_SIGNALS = [r"\(\d{4}[a-z]?\)", r"(?i)\b(?:journal|proceedings|conference|review|corpus|studies)\b", r"https?://", r"(?i)\bdoi\b",
                     r"\b\d+\s*[,:]\s*\d+(?:[–-]\d+)?\b"]
METADATA_REFERENCE_SIGNALS = [r"\(\d{4}[a-z]?\)", r"(?i)https?://|\bdoi\b", r"(?i)\b(?:journal|proceedings|conference|studies|review|corpus)\b",
                              r"\b\d+\s*[,:]\s*\d+(?:[–-]\d+)?\b"]
AFFILIATIONS = ["university", "college", "department", "faculty", "school", "institute", "center", "centre", "laboratory", "lab", "hospital"]
METADATA_AFFILIATIONS = [*AFFILIATIONS, "tech", "research", "academy", "sciences", "engineering", "laboratories"]
FRONT_MATTER_HEADINGS = ["abstract", "background", "introduction", "methods", "references", "acknowledgment", "acknowledgement",
                         "declaration of use of ai"]
PERSON = r"^[A-Z][A-Za-z'`\-]+(?:\s+[A-Z](?:\.)?)?(?:\s+[A-Z][A-Za-z'`\-]+){0,3}$"
AUTHOR_LINE = r"^[A-Z][A-Za-z.\-'\s,&]+$"
NAMES_INSIDE = r"[A-Z][A-Za-z'`\-]+(?:\s+[A-Z](?:\.)?)?(?:\s+[A-Z][A-Za-z'`\-]+)+"
NAME_TOKEN = r"^[A-Z][A-Za-z'`\-]*\.?$"
EXCLUDED_TITLES = ["vocabulary learning and instruction", "abstract"]
AUTHOR_MARKS = r"(?:\^\{[^}]+\}|\[[^\]]+\]|[\*†‡§¶‖]+|\b\d+\b(?=\s*[A-Z]))"
NUMBERED_HEADING = r"^\d+(?:\.\d+)*\s+[A-Z]"
YEAR, VOLUME, ISSUE = r"\b((?:19|20)\d{2})\b", r"(?i)\bVolume\s+(\d+)\b", r"(?i)\b(?:Number|Issue)\s+(\d+)\b"
DOI, ISSN = r"(?i)(https?://doi\.org/\S+|\b10\.\d{4,9}/\S+)", r"\bISSN\s+([0-9Xx\-]+)\b"
TITLE_FAMILIES = {
    "abstract": ["abstract"],
    "introduction": ["introduction", "background", "related work", "literature review"],
    "method": ["method", "methods", "methodology", "materials and methods", "experimental setup", "experiment", "experiments", "procedure",
               "procedures", "participants", "materials", "data", "data collection", "corpus", "text generation using chatgpt",
               "vocabulary level analysis using software", "topic analysis method", "seed demonstration collection"],
    "results": ["result", "results", "finding", "findings", "analysis", "analyses", "evaluation", "evaluations", "topic frequency"],
    "discussion": ["discussion", "conclusion", "conclusions", "limitations", "implications", "future directions"],
}
LABELS = [*TITLE_FAMILIES]
CEFR_TITLE = r"^[abc]\d(?:\.\d+)?$"
ANSWER_MODES = ["direct_answer", "compare", "critique", "recommend", "clarify_insufficient_evidence"]
ANSWER_ALIASES = {
    "evidence_retrieval": "direct_answer", "synthesize": "direct_answer", "synthesis": "direct_answer", "summarize": "direct_answer",
    "summary": "direct_answer", "comparison": "compare", "compare_approaches": "compare", "recommendation": "recommend",
}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&ndash;": "–",
            "&mdash;": "—", "&hellip;": "…"}
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or",
              "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with"]
