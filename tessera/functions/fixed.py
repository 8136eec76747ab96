"""Word lists, patterns and weights that decide results. They are data, not tunable."""

# --- triples -------------------------------------------------------------------------------------
NULL_LIKE = [r"\s*null\s*", r"\s*none\s*", r"\s*n/?a\s*", r"\s*unknown\s*", r"\s*undefined\s*", r"\s*empty\s*", r"\s*[-–—]+\s*", r"\s*[?]+\s*", r"\s*tbd\s*", r"\s*to\s+be\s+determined\s*", r"\s*"]
LOW_QUALITY_MARKS = ["disambiguation", "may refer to", "stub", "redirect", "see also", "category:", "template:", "file:", "image:", "wikipedia:", "user:", "talk:", "help:", "portal:"]
MEANINGLESS_RELATIONS = ["is", "has", "contains", "includes", "related to", "associated with", "connected to", "linked to", "similar to", "comparable to", "like", "such as"]
SMALL_WORDS = ["the", "and", "or", "of", "in", "on", "at", "to", "for", "with"]

# --- classes of facts ----------------------------------------------------------------------------
ATTRIBUTE_VALUES = [
    r"\d+(\.\d+)?\s*(km|AU|light-years?|years?|billion years?|million years?|°C|°F|K)",
    r"\d+(\.\d+)?\s*%",
    r"\d+(\.\d+)?\s*(kg|g|tons?|solar masses?)",
    r"\d+(\.\d+)?\s*(m/s|km/s|km/h)",
    r"(about|approximately|roughly|around)?\s*\d+(\.\d+)?\s*(billion|million)?\s*years?\s*(ago|from now)?",
    r"(solid|liquid|gas|plasma)",
    r"(hot|cold|warm|cool|frozen)",
    r"(bright|dim|dark|luminous)",
    r"(red|blue|yellow|white|orange|green|purple|black)(-\w+)?",
    r"(large|small|huge|tiny|massive|compact)",
    r"(hydrogen|helium|carbon|oxygen|nitrogen|iron|silicon|water|methane|ammonia|carbon dioxide)",
    r"(true|false|yes|no|present|absent|active|inactive)",
    r"(north|south|east|west|inner|outer|upper|lower|central)",
]
ATTRIBUTE_WORDS = ["temperature", "mass", "diameter", "radius", "density", "gravity", "pressure", "age", "period", "duration", "time", "date", "year", "distance", "size", "volume", "area", "height", "width", "length", "composition", "material", "element", "compound", "atmosphere", "phase", "state", "condition", "status", "type", "class", "category", "color", "brightness", "magnitude", "luminosity", "spectrum"]
ATTRIBUTE_PREDICATES = ["has", "is", "measures", "weighs", "contains", "composed of", "temperature", "mass", "diameter", "age", "distance", "size", "color", "brightness", "density", "pressure", "gravity"]
ENTITY_WORDS = ["star", "planet", "moon", "asteroid", "comet", "galaxy", "nebula", "constellation", "asterism", "nasa", "esa", "iau", "observatory", "institute", "university", "astronomer", "scientist", "discoverer", "mission", "probe", "spacecraft", "telescope", "satellite", "belt", "cloud", "zone", "region", "system"]
EVENT_VERBS = ["dimmed", "brightened", "exploded", "collapsed", "formed", "evolved", "discovered", "observed", "detected", "measured", "recorded", "moved", "orbited", "rotated", "accelerated", "ejected", "collided", "impacted", "merged", "separated", "approached", "receded", "increased", "decreased", "changed", "transformed", "converted", "expanded", "contracted", "cooled", "heated", "ignited", "extinguished", "imaged", "photographed", "analyzed", "studied", "surveyed", "mapped", "scanned", "monitored", "tracked", "sampled", "launched", "deployed", "landed", "docked", "undocked", "activated", "deactivated", "repaired", "upgraded", "decommissioned"]
EVENT_TYPES = ["dimming", "brightening", "explosion", "collision", "formation", "discovery", "observation", "measurement", "movement", "orbit", "rotation", "acceleration", "ejection", "impact", "merger", "approach", "recession", "increase", "decrease", "change", "transformation", "expansion", "contraction", "cooling", "heating", "imaging", "analysis", "study", "survey", "mapping", "launch", "deployment", "landing", "docking", "activation", "deactivation", "repair", "upgrade", "decommission"]

# --- web text ------------------------------------------------------------------------------------
BOILERPLATE = ["'Just a moment", "To ensure we keep this website safe", "COOKIES", "Please enable JavaScript", "This site requires JavaScript", "Loading", "Advertisement", "Skip to", "Click here", "Read more", "Continue reading"]
USELESS_MARKS = ["cookie", "gdpr", "privacy policy", "terms of service", "subscribe", "newsletter", "advertisement", "sponsored", "loading", "please wait", "error", "404", "403", "500"]
EXCLUDED_TAGS = ["script", "style", "nav", "header", "footer", "aside", "advertisement", "ads", "sidebar", "menu", "breadcrumb"]
EXCLUDED_CLASSES = ["advertisement", "ads", "sidebar", "menu", "nav", "footer", "header", "breadcrumb", "social", "share", "comment", "popup", "modal", "overlay", "cookie", "gdpr"]
EXCLUDED_IDS = ["advertisement", "ads", "sidebar", "menu", "nav", "footer", "header", "comments", "social", "share"]
MAIN_SELECTORS = ["main", "article", ".content", ".main-content", ".article-content", ".post-content", "#content", ".entry-content", ".page-content", "#mw-content-text"]
BLOCK_TAGS = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "div"]
EXCLUDED_SECTIONS = [r"references?", r"external\s+links?", r"see\s+also", r"further\s+reading", "bibliography", "notes?", "citations?", "sources?", "gallery", "images?", "media", r"popular\s+culture", r"in\s+fiction", "trivia", "miscellaneous", "awards?", "honors?", "legacy", "memorials?", "commemoration"]
ARTICLE_MARKS = ["stub", "disambiguation", "redirect", "may refer to", "is a disambiguation page", "this article is a stub"]
LABEL_SYNONYMS = {"right_ascension": "ra", "declination": "dec", "apparent_magnitude": "magnitude", "absolute_magnitude": "abs_magnitude", "spectral_type": "spectral_class", "surface_temperature": "temperature"}
EMPTY_DATA = [r"\s*[-–—]+\s*", r"\s*[?]+\s*", r"\s*n/?a\s*", r"\s*unknown\s*", r"\s*tbd\s*"]

# --- links ---------------------------------------------------------------------------------------
EXCLUDED_DOMAINS = ["pinterest.com", "instagram.com", "facebook.com", "twitter.com", "linkedin.com", "youtube.com", "tiktok.com", "reddit.com", "quora.com", "yahoo.com", "bing.com", "google.com", "dictionary.cambridge.org", "iciba.com", "collinsdictionary.com", "merriam-webster.com", "dictionary.com", "vocabulary.com", "wordreference.com", "zhidao.baidu.com", "baike.baidu.com", "zhihu.com", "dict.eudic.net", "englishtour.cn", "koolearn.com", "bbs.pubg.game.daum.net", "daum.net"]
EXCLUDED_URL_WORDS = ["pdf", "abstract", "articles", "image", "video", "download", "login", "register", "subscribe", "buy", "shop", "cart", "advertisement", "ads", "sponsored", "promotion", "dictionary", "词典", "翻译", "是什么意思", "iciba", "youdao"]
EXCLUDED_EXTENSIONS = [".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx"]
PREFERRED_DOMAINS = ["wikipedia.org", "arxiv.org", "nature.com", "science.org", "aaas.org", "nasa.gov", "esa.int", "iau.org", "noao.edu", "nrao.edu", "stsci.edu", "spitzer.caltech.edu", "hubblesite.org", "jwst.nasa.gov", "chandra.harvard.edu", "fermi.gsfc.nasa.gov", "keckobservatory.org", "gemini.edu", "vlt.eso.org", "eso.org", "alma.cl", "ligo.org", "virgo-gw.eu", "ska-telescope.org", "atnf.csiro.au", "naic.edu", "gb.nrao.edu", "caltech.edu", "harvard.edu", "mit.edu", "stanford.edu", "ox.ac.uk", "cam.ac.uk", "cern.ch", "noaa.gov", "berkeley.edu", "princeton.edu", "yale.edu", "columbia.edu", "uchicago.edu", "arizona.edu", "hawaii.edu", "simbad.cds.unistra.fr", "vizier.cds.unistra.fr", "ned.ipac.caltech.edu", "irsa.ipac.caltech.edu", "heasarc.gsfc.nasa.gov", "adc.gsfc.nasa.gov", "exoplanetarchive.ipac.caltech.edu", "gaia.ari.uni-heidelberg.de", "aanda.org", "mnras.oxfordjournals.org", "iopscience.iop.org", "apj.aas.org", "aj.aas.org", "pasp.aas.org", "astropy.org", "scipy.org", "numpy.org", "matplotlib.org", "skyandtelescope.org", "astronomy.com", "universetoday.com", "space.com", "timeanddate.com", "earthsky.org", "cospar-assembly.org", "iaus.org", "astronomer.org"]
SCIENCE_HOST_WORDS = ["astro", "space", "cosmic", "stellar", "planet", "galaxy", "solar", "telescope", "observatory", "radio", "optical", "infrared", "xray", "hubble", "spitzer", "chandra", "kepler", "jwst", "gaia", "alma", "keck", "gemini", "vlt", "ligo", "virgo", "ska", "nrao", "eso", "simbad", "vizier", "ned", "irsa", "heasarc", "exoplanet"]
#: "supernova" stands twice and counts twice.
SCIENCE_KEYWORDS = ["astronomy", "astrophysics", "cosmology", "astrometry", "astrobiology", "stellar", "galactic", "planetary", "extragalactic", "interstellar", "star", "planet", "galaxy", "nebula", "supernova", "pulsar", "quasar", "black hole", "neutron star", "white dwarf", "brown dwarf", "exoplanet", "asteroid", "comet", "meteor", "meteorite", "solar system", "eclipse", "transit", "occultation", "conjunction", "opposition", "gravitational wave", "gamma ray burst", "supernova", "nova", "variable star", "binary star", "multiple star", "stellar evolution", "telescope", "observatory", "spectrometer", "photometry", "spectroscopy", "interferometry", "radio astronomy", "x-ray astronomy", "infrared astronomy", "optical astronomy", "space telescope", "ground-based telescope", "redshift", "parallax", "luminosity", "magnitude", "flux", "spectrum", "doppler effect", "cosmic microwave background", "dark matter", "dark energy", "big bang", "cosmic inflation", "nucleosynthesis", "accretion disk", "observation", "research", "study", "analysis", "discovery", "scientific", "measurement", "calibration", "data reduction", "modeling", "simulation", "survey", "catalog", "database", "archive"]
LOW_QUALITY_LINK_WORDS = ["blog", "forum", "discussion", "opinion", "review", "buy", "sell", "price", "cheap", "discount"]
BLOCKED_LINK_WORDS = ["pdf", "abstract", "articles", "image", "view", "video"]

# --- sources -------------------------------------------------------------------------------------
AUTHORITY_WEIGHTS = {"simbad": 1.0, "academic_paper": 0.9, "wikipedia": 0.7, "web_news": 0.5, "general_web": 0.6}
AUTHORITY_A = [("simbad", ["simbad", "cds.unistra.fr"]), ("academic_paper", ["arxiv.org", "nature.com", "science.org", "iopscience", "aanda.org", "apj", "mnras"]), ("wikipedia", ["wikipedia.org"]), ("web_news", ["news", "xinhuanet", "bbc.com/news", "cnn.com"])]
AUTHORITY_B = [("simbad", ["simbad"]), ("academic_paper", ["arxiv.org", "doi.org", "nature.com", "science.org", "iopscience.iop.org", "academic.oup.com"]), ("wikipedia", ["wikipedia.org"]), ("web_news", ["news", "reuters.com", "apnews.com", "xinhuanet.com"])]
#: Seconds at the start of the year 2100, the unit of time in score A.
TIME_UNIT = 4102444800
BLOCKED_TEXT_MARKS = ("just a moment", "to ensure we keep this website safe", "cookies", "enable javascript")
