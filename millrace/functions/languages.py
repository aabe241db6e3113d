"""English names of language codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ISO 639-1 codes and English names, with the three withdrawn
# codes (in, iw, ji) that Java's Locale still answers.
ISO_639_1 = """
aa Afar
ab Abkhazian
ae Avestan
af Afrikaans
ak Akan
am Amharic
an Aragonese
ar Arabic
as Assamese
av Avaric
ay Aymara
az Azerbaijani
ba Bashkir
be Belarusian
bg Bulgarian
bh Bihari
bi Bislama
bm Bambara
bn Bangla
bo Tibetan
br Breton
bs Bosnian
ca Catalan
ce Chechen
ch Chamorro
co Corsican
cr Cree
cs Czech
cu Church Slavic
cv Chuvash
cy Welsh
da Danish
de German
dv Divehi
dz Dzongkha
ee Ewe
el Greek
en English
eo Esperanto
es Spanish
et Estonian
eu Basque
fa Persian
ff Fulah
fi Finnish
fj Fijian
fo Faroese
fr French
fy Western Frisian
ga Irish
gd Scottish Gaelic
gl Galician
gn Guarani
gu Gujarati
gv Manx
ha Hausa
he Hebrew
hi Hindi
ho Hiri Motu
hr Croatian
ht Haitian Creole
hu Hungarian
hy Armenian
hz Herero
ia Interlingua
id Indonesian
ie Interlingue
ig Igbo
ii Sichuan Yi
ik Inupiaq
in Indonesian
io Ido
is Icelandic
it Italian
iu Inuktitut
iw Hebrew
ja Japanese
ji Yiddish
jv Javanese
ka Georgian
kg Kongo
ki Kikuyu
kj Kuanyama
kk Kazakh
kl Kalaallisut
km Khmer
kn Kannada
ko Korean
kr Kanuri
ks Kashmiri
ku Kurdish
kv Komi
kw Cornish
ky Kyrgyz
la Latin
lb Luxembourgish
lg Ganda
li Limburgish
ln Lingala
lo Lao
lt Lithuanian
lu Luba-Katanga
lv Latvian
mg Malagasy
mh Marshallese
mi Maori
mk Macedonian
ml Malayalam
mn Mongolian
mo Moldavian
mr Marathi
ms Malay
mt Maltese
my Burmese
na Nauru
nb Norwegian Bokmål
nd North Ndebele
ne Nepali
ng Ndonga
nl Dutch
nn Norwegian Nynorsk
no Norwegian
nr South Ndebele
nv Navajo
ny Nyanja
oc Occitan
oj Ojibwa
om Oromo
or Odia
os Ossetic
pa Punjabi
pi Pali
pl Polish
ps Pashto
pt Portuguese
qu Quechua
rm Romansh
rn Rundi
ro Romanian
ru Russian
rw Kinyarwanda
sa Sanskrit
sc Sardinian
sd Sindhi
se Northern Sami
sg Sango
si Sinhala
sk Slovak
sl Slovenian
sm Samoan
sn Shona
so Somali
sq Albanian
sr Serbian
ss Swati
st Southern Sotho
su Sundanese
sv Swedish
sw Swahili
ta Tamil
te Telugu
tg Tajik
th Thai
ti Tigrinya
tk Turkmen
tl Tagalog
tn Tswana
to Tongan
tr Turkish
ts Tsonga
tt Tatar
tw Twi
ty Tahitian
ug Uyghur
uk Ukrainian
ur Urdu
uz Uzbek
ve Venda
vi Vietnamese
vo Volapük
wa Walloon
wo Wolof
xh Xhosa
yi Yiddish
yo Yoruba
za Zhuang
zh Chinese
zu Zulu
"""

LANGUAGE_NAMES: dict[str, str] = dict(line.split(" ", 1) for line in ISO_639_1.strip().splitlines())


def language_table(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    rows = list((LANGUAGE_NAMES if names is None else names).items())
    return spark.createDataFrame(rows, "iso_code string, iso_name string")


def with_language_name(
    df: DataFrame, code: str, name: str = "language", names: dict[str, str] | None = None
) -> DataFrame:
    """Add the English name of ``code``; an unknown code names itself in lower case.

    The lookup table is a literal of fewer than 200 rows, hence the broadcast.
    """
    table = F.broadcast(language_table(df.sparkSession, names))
    wanted: Column = F.lower(F.col(code))
    return (
        df.join(table, wanted == table["iso_code"], "left")
        .withColumn(name, F.coalesce(F.col("iso_name"), wanted))
        .drop("iso_code", "iso_name")
    )
