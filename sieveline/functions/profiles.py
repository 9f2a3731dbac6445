"""What a target language's checks know of it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LanguageProfile:
    code: str
    special_chars: str
    stopwords: tuple[str, ...]
    boilerplate: tuple[str, ...]


#: Characters, stopwords and page phrases that the Turkish checks count.
TURKISH = LanguageProfile(
    code="tr",
    special_chars="çÇğĞıİöÖşŞüÜ",
    stopwords=(
        "bir", "ve", "bu", "da", "de", "ile", "için", "olan", "gibi",
        "daha", "en", "çok", "ne", "var", "ben", "sen", "biz", "siz",
        "o", "onlar", "ama", "fakat", "ancak", "veya", "ya", "ki",
        "mi", "mı", "mu", "mü", "değil", "her", "kadar", "sonra",
        "önce", "şu", "olarak", "üzere", "ise", "hem", "çünkü",
        "ayrıca", "böyle", "şekilde", "oldu", "olduğu",
        "olduğunu", "olduğundan", "yapılan", "tarafından", "ilgili",
        "birçok", "dolayı", "nasıl", "neden", "zaman", "yani",
        "bile", "artık", "bunu", "buna", "bunun", "bunlar",
        "şey", "diğer", "hangi", "kendi", "aynı", "bazı", "büyük",
        "küçük", "iyi", "kötü", "yeni", "eski", "olma",
        "olup", "ederek", "edilmiş", "eden", "etmek",
    ),
    boilerplate=(
        r"cookie\s*(policy|kullan|tercih|ayar)",
        r"çerez\s*(politika|kullan|tercih|ayar)",
        r"gizlilik\s*(politika|sözleşm|bildirim)",
        r"privacy\s*policy",
        r"terms\s*(of|and)\s*(service|use)",
        r"kullanım\s*(koşul|şart|sözleşm)",
        r"aydınlatma\s*metni",
        r"kvkk",
        r"kişisel\s*veri",
        r"copyright\s*©",
        r"tüm\s*hakları\s*saklıdır",
        r"all\s*rights\s*reserved",
        r"ana\s*sayfa\s*[|>»]",
        r"site\s*haritası",
        r"iletişim\s*formu",
        r"hakkımızda\s*[|>»]",
        r"menü\s*kapat",
        r"abone\s*ol\w*\s*bülten",
        r"subscribe",
        r"click\s*here",
        r"read\s*more",
        r"devamını\s*oku",
    ),
)

#: Frequent function words of other languages; what a text is told from when nothing better says its language.
FUNCTION_WORDS = {
    "az": ("və", "bu", "ilə", "üçün", "bir", "də", "olan", "onun", "edir", "kimi", "isə", "çox", "daha", "o", "da", "var", "ki", "həm"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "eine", "zu", "den", "mit", "von", "auf", "für", "dem", "sich", "auch", "war"),
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "with", "on", "are", "this", "be", "have", "not", "they"),
    "es": ("el", "la", "los", "de", "que", "y", "en", "un", "una", "por", "con", "para", "del", "se", "las", "no", "es", "su"),
    "fr": ("le", "la", "les", "et", "des", "est", "une", "dans", "que", "qui", "pour", "pas", "sur", "avec", "du", "il", "au", "plus"),
    "it": ("il", "di", "che", "e", "la", "per", "non", "con", "sono", "della", "una", "le", "gli", "è", "del", "si", "nel", "anche"),
    "nl": ("de", "het", "een", "van", "en", "in", "is", "dat", "op", "te", "zijn", "voor", "niet", "met", "er", "aan", "ook", "die"),
    "pt": ("o", "de", "que", "e", "do", "da", "em", "um", "para", "com", "não", "uma", "os", "no", "se", "na", "as", "são"),
    "ru": ("и", "в", "не", "на", "что", "с", "по", "это", "как", "он", "из", "для", "но", "к", "за", "от", "был", "все"),
}

#: Turkish suffixes that a vocabulary extension prefers.
TURKISH_SUFFIXES = (
    "lar", "ler", "dır", "dir", "dur", "dür", "tır", "tir", "tur", "tür",
    "dan", "den", "tan", "ten", "lık", "lik", "luk", "lük", "yor", "acak",
    "ecek", "miş", "mış", "muş", "müş", "siniz", "sınız", "sunuz", "sünüz",
    "ımız", "imiz", "umuz", "ümüz", "ları", "leri", "larına", "lerine",
    "larından", "lerinden", "acağı", "eceği", "acaklar", "ecekler", "acaktır",
    "ecektir",
)
