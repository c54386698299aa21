"""Word lists about names, shared by name linking and the search for personal data. All entries are fixed values."""

from __future__ import annotations

import functools
import unicodedata

# Common first names, Italian and English.
FIRST_NAMES = set(
    """
adele alberto aldo alessandra alessandro alessia alessio alfredo alice amelia andrea angela angelo anna antonella antonio arianna arturo augusto barbara
beatrice benedetta bianca bruno camilla carla carlo carolina caterina cecilia chiara cinzia clara claudia claudio corrado cristina cristiano daniela daniele
dario davide debora diego domenico donatella edoardo elena eleonora elisa elisabetta emanuele emilia enrico ernesto eva fabio fabrizio federica federico
ferdinando filippo flavia flavio franca francesca francesco franco gabriele gaia giacomo gianluca gino giorgia giorgio giovanna giovanni giulia giulio giuseppe grazia
gregorio guido ilaria irene isabella ivana ivano jacopo laura lavinia leonardo letizia lidia linda livia lorena lorenzo luca lucia luciano luigi luisa manuela
marcello marco margherita maria marina mario marta martina massimo matilde matteo maurizio michela michele mirella monica nadia nicola nicolo noemi oscar paola
paolo patrizia piero pietro raffaele renato renzo riccardo roberta roberto rocco rosa salvatore sara sergio silvano silvia simona simone sofia stefania stefano stella
teresa tiziana tommaso ugo umberto valentina valeria valerio vincenzo virginia vittoria vittorio zeno
    """.split()
    + """
adam albert alexander amanda amy andrew ashley benjamin brian carol catherine charles christine christopher daniel david deborah diana donald dorothy edward elizabeth emily
emma eric frank gary george grace hannah harold harry helen henry howard jack james jane janet jason jennifer jessica joan john jonathan joseph joshua judith julia
karen katherine kenneth kevin kimberly larry laurence lisa louise margaret mark martin mary matthew melissa michael michelle nancy nicholas oliver oscar pamela patricia patrick paul peter
philip rachel raymond rebecca richard robert ronald ruth ryan samuel sandra sarah scott sharon simon stephanie stephen steven susan theresa thomas timothy victoria walter william
    """.split()
)

# Short and pet forms, with the names they stand for.
PET_NAMES = {
    k: v.split()
    for k, v in {
        "ale": "alessandro alessandra", "sandra": "alessandra", "sandro": "alessandro", "anto": "antonio antonella", "nella": "antonella",
            "tonino": "antonio", "toni": "antonio", "tonio": "antonio",
        "nanni": "giovanni", "gianni": "giovanni", "vanni": "giovanni", "nino": "antonio giovanni", "beppe": "giuseppe", "peppe": "giuseppe",
            "peppino": "giuseppe", "pino": "giuseppe", "geppi": "giuseppe",
        "gigi": "luigi", "gino": "luigi", "luigino": "luigi", "mimmo": "domenico", "nico": "nicolo nicola", "nick": "nicholas", "toto": "salvatore",
            "turi": "salvatore", "salvo": "salvatore",
        "enzo": "vincenzo lorenzo", "cenzo": "vincenzo", "renzo": "lorenzo", "lele": "emanuele raffaele gabriele", "manu": "emanuele manuela",
            "lello": "raffaele", "raffa": "raffaele raffaella", "leo": "leonardo", "nardo": "leonardo",
        "tommy": "tommaso thomas", "masino": "tommaso", "teo": "matteo", "vale": "valentina valeria valerio", "fede": "federica federico",
            "chicca": "federica francesca", "rita": "margherita", "marghe": "margherita", "meg": "margaret", "maggie": "margaret",
            "peggy": "margaret",
        "rina": "caterina", "cate": "caterina catherine", "katia": "caterina", "titti": "teresa", "terry": "teresa theresa", "resy": "teresa",
            "lory": "lorena", "lella": "raffaella gabriella", "betta": "elisabetta", "lisa": "elisabetta elizabeth", "lisetta": "elisabetta",
            "elly": "elena", "ely": "elisabetta elena",
        "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lizzie": "elizabeth", "eliza": "elizabeth", "bill": "william",
            "billy": "william", "will": "william", "willy": "william", "bob": "robert", "bobby": "robert", "rob": "robert", "robbie": "robert",
            "bert": "robert albert",
        "dick": "richard", "rich": "richard", "rick": "richard", "ricky": "richard", "howie": "howard", "ward": "howard", "kary": "karen",
            "kari": "karen", "greg": "gregorio gregory", "goyo": "gregorio", "dado": "dario edoardo", "rino": "salvatore silvano",
            "silvio": "silvano", "silva": "silvana",
        "stellina": "stella", "moni": "monica", "nica": "monica", "mony": "monica", "paoletta": "paola", "pietro": "piero", "pierino": "piero",
            "marti": "marta martina", "noe": "noemi", "mimi": "noemi", "irenina": "irene", "flavietto": "flavio", "ivo": "ivano", "vanni ": "ivano",
            "bianchina": "bianca", "claretta": "clara", "ughetto": "ugo", "roccuccio": "rocco",
        "jim": "james", "jimmy": "james", "joe": "joseph", "jack": "john", "mike": "michael", "tom": "thomas", "tim": "timothy", "dan": "daniel",
            "dave": "david", "chris": "christopher christine", "kate": "catherine katherine", "kathy": "catherine katherine", "sue": "susan",
            "steve": "stephen steven", "tony": "anthony antonio", "ed": "edward", "ted": "edward", "sam": "samuel", "ben": "benjamin",
            "alex": "alexander alessandro", "andy": "andrew", "matt": "matthew matteo", "pat": "patricia patrick", "ron": "ronald", "ken": "kenneth",
            "larry": "laurence",
    }.items()
}

# Titles before a surname.
TITLES = "sig sigg sigra signor signora signorina dott dottssa dr dssa ing avv geom rag arch prof profssa cav on mr mrs ms miss mx sir madam rev".split()

# Legal forms of organisations, without dots and blanks.
LEGAL_FORMS = set(
    "spa srl srls sapa scarl scrl scpa snc sas ss soccoop onlus ltd limited plc llp llc inc corp corporation co company gmbh ag kg ohg ug se sa sarl sas bv nv ab oy as aps".split())

# Legal forms written out.
LEGAL_PHRASES = ["societa per azioni", "societa a responsabilita limitata", "societa in nome collettivo", "societa in accomandita semplice",
    "societa cooperativa", "public limited company", "gesellschaft mit beschrankter haftung"]

# Words about trade or size that organisations add to their name.
TRADE_WORDS = set(
    """
aeronautica alimentare alimentari ambiente analytics assicurazioni assistenza associati automazione banca capital chimica cloud commerciale communications consulenza consulting costruzioni data digital
distribuzione editoriale elettronica elettrica energia energy engineering enterprise farmaceutica finance finanziaria formazione global gomma group gruppo health holding immobiliare impianti industria industriale
industrie industries informatica ingegneria insurance international internazionale italia italiana labs lavori legal logistica logistics manufacturing marittima marketing meccanica media medica navale networks partners
pharma plastica progetti research reti ricerche security services servizi sicurezza siderurgica sistemi software solutions studio systems technologies technology tecnica tecnologie telecom telecomunicazioni telematica tessile trading trasporti turismo
viaggi
    """.split()
)

# Abbreviations that are no beginnings of their word.
TRADE_SHORT = {"grp": "group", "gr": "group", "mfg": "manufacturing", "intl": "international", "svc": "services", "mgmt": "management",
    "tlc": "telecomunicazioni", "eng": "engineering", "ing": "ingegneria", "int": "international"}


@functools.lru_cache(100_000)
def fold(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
