"""Word lists, lookup tables and patterns that decide results."""

from __future__ import annotations

# --- contacts

FREEMAIL_DOMAINS = (
    "aol.com bk.ru free.fr gmail.com googlemail.com hotmail.com icloud.com inbox.ru internet.ru libero.it list.ru live.com mac.com mail.ru "
    "me.com msn.com orange.fr outlook.com pm.me proton.me protonmail.ch protonmail.com rocketmail.com t-online.de wanadoo.fr web.de yahoo.com ymail.com"
).split()
FREEMAIL_BRANDS = "aol gmx hotmail laposte live outlook yahoo yandex".split()
ROLE_LOCALS = "admin comercial contact contacto contato enquiries hello hola info kontakt mail marketing office orders post sales service shop support ventas".split()
EU_TLDS = "at be bg cy cz de dk ee es eu fi fr gr hr hu ie it lt lu lv mt nl pl pt ro se si sk".split()
CASL_TLDS, PECR_TLDS = ["ca"], ["uk"]
PERMISSIVE_TLDS = "au co com net nz org shop store us".split()
COLD_EMAIL_OK = ("PERMISSIVE", "PECR")

EMAIL_SCAN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
EMAIL_VALID = r"^[^@\s]+@[^@\s]+\.[a-z]{2,}$"
EMAIL_TRIM = ".,;:'\"<>()[]"
HEADER_WORDS = "created date domain email emails".split()

# --- pages

#: (platform, pattern of the body, prefixes of header names, text in headers), in order.
PLATFORMS = (
    ("Shopify", r"cdn\.shopify\.com|/cdn/shop/|Shopify\.theme|\.myshopify\.com|shopify-features|/cdn/shopifycloud/", ("x-shopid", "x-shopify-stage"), ("shopify",)),
    ("WooCommerce", r'wp-content/plugins/woocommerce|woocommerce-page|woocommerce-js|wc-add-to-cart|wc-ajax=|class="[^"]*woocommerce', (), ()),
    ("BigCommerce", r"cdn11\.bigcommerce\.com|bigcommerce\.com/s-|bigcommerce\.com/shared|stencil-utils", ("x-bc-",), ()),
    ("Magento", r"Magento_|/static/version\d|data-mage-init|mage/cookies|mage-init|/pub/static/frontend/|Mage\.Cookies", ("x-magento-",), ()),
    ("PrestaShop", r"prestashop|/modules/ps_|var prestashop", (), ("prestashop",)),
    ("Wix", r"_wixCssVars|static\.parastorage\.com|wixstatic\.com|wix-(?:dropdown|image|code)|X-Wix-", ("x-wix-request-id", "x-wix-"), ()),
    ("Squarespace", r"static1\.squarespace\.com|squarespace\.com/universal|Squarespace\.afterBodyLoad|assets\.squarespace\.com", (), ("squarespace",)),
    ("OpenCart", r"catalog/view/theme|index\.php\?route=common|route=checkout/cart", (), ()),
)
CART = (
    r"""(?:href|action)\s*=\s*["'][^"']*/(?:cart|checkout|basket|panier)\b""",
    r"""["'](?:/)?(?:cart|checkout|basket|panier)(?:/|["'?#])""",
    r"add[-_ ]?to[-_ ]?cart",
)
PRODUCT_SCHEMA = (
    r'"@type"\s*:\s*"(?:Product|Offer|AggregateOffer)"',
    r'"@type"\s*:\s*\[[^\]]*"(?:Product|Offer)"',
    r"""itemtype\s*=\s*["'][^"']*schema\.org/(?:Product|Offer)""",
)
PARKED = (
    r"\b(?:this )?domain (?:is )?(?:for sale|is available|parked)\b",
    r"\bbuy this domain\b",
    r"\bdomain (?:name )?parking\b",
    r"\bcoming soon\b.{0,80}\b(?:domain|website)\b",
    r"\b(?:sedoparking|parkingcrew|bodis|afternic|dan\.com|hugedomains|namecheap parking)\b",
    r"\bunder construction\b",
    r"\bdefault web site page\b",
    r"\bapache2? (?:ubuntu|debian) default page\b",
    r"\bwelcome to nginx\b",
    r"\bindex of /\b",
)
TITLE = r"<title[^>]*>(.*?)</title>"
HTML_LANG = r"""<html[^>]*\slang\s*=\s*["']?([A-Za-z\-]{2,10})"""
OG_IMAGE = r"""<meta[^>]+(?:property|name)\s*=\s*["']og:image["'][^>]*>"""
META_DESCRIPTION = r"""<meta[^>]+name\s*=\s*["']description["'][^>]+content\s*=\s*["'][^"']{1,400}["']"""
#: Characters that a workbook cannot hold.
ILLEGAL_CELL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
#: Characters that a title loses.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
TITLE_CHARS = 300
MAX_BODY_BYTES = 200 * 1024

#: (kind, pattern with the handle as its group), in order of preference.
LINKEDIN = (
    ("personal", r"https?://(?:[a-z]{2,3}\.)?linkedin\.com/in/([A-Za-z0-9_\-.%]+)"),
    ("personal", r"https?://(?:[a-z]{2,3}\.)?linkedin\.com/pub/([A-Za-z0-9_\-.%/]+)"),
    ("company", r"https?://(?:[a-z]{2,3}\.)?linkedin\.com/company/([A-Za-z0-9_\-.%]+)"),
    ("company", r"https?://(?:[a-z]{2,3}\.)?linkedin\.com/(?:showcase|school)/([A-Za-z0-9_\-.%]+)"),
    ("short", r"https?://lnkd\.in/([A-Za-z0-9_\-]+)"),
)
LINKEDIN_NOISE = "company-beta cws events feed groups help jobs learning legal login posts pulse search share sharearticle shareoffsite sharing signup uas".split()
LEGAL_PAGE = (
    r"""href\s*=\s*["']([^"']*(?:impressum|imprint|legal-?notice|aviso-?legal|mentions-?legales|note-?legali|informazioni-?legali|colofon"""
    r"""|informacion-?legal|legal-?information|kontakt-?impressum)[^"']*)["']"""
)

# --- owners of a site, as named on its legal notice

NAME_WORD = r"[A-ZÄÖÜÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÇÑ][\wÄÖÜäöüßÁÉÍÓÚáéíóúÀÈÌÒÙàèìòùÂÊÎÔÛâêîôûÇçÑñ'’\-]{1,30}"
NAME_PARTICLE = r"(?:de|del|della|di|da|dos|du|van|von|der|den|ter|te|le|la|el|al|bin|ibn|of|op|het|'t)"
TRAILING_PARTICLE = r"[ \-](?:de|del|della|di|da|dos|du|van|von|der|den|ter|te|le|la|el|al)$"
OWNER_LABELS = (
    r"Vertreten\s+durch",
    r"Inhaber(?:in)?",
    r"Gesch[aä]ftsf[uü]hrer(?:in)?",
    r"Vertretungsberechtigt(?:er|e)?",
    r"Eigent[uü]mer(?:in)?",
    r"Titular",
    r"Responsable",
    r"Representante\s+legal",
    r"Legale\s+rappresentante",
    r"Rappresentante\s+legale",
    r"Titolare",
    r"Directeur\s+de\s+la\s+publication",
    r"Responsable\s+de\s+publication",
    r"Eigenaar",
    r"Bestuurder",
    r"Owner",
    r"Managing\s+Director",
    r"Proprietor",
)
OWNER_HONORIFICS = "Herr Frau Mr Mrs Ms Dhr Mevr".split()
OWNER_TITLES = (
    "dr prof dipl ing mag mba msc bsc med phd herr frau mr mrs ms dhr mevr sr sra don ministerialdirektor ministerialrat direktor director geschäftsführer "
    "geschaeftsfuehrer inhaber inhaberin eigentümer eigentuemer vorstand president presidente rechtsanwalt steuerberater apotheker architekt"
).split()
COMPANY_WORDS = (
    "gmbh ug kg ohg gbr ag mbh co kgaa ev e.v ltd limited llc inc plc bv b.v nv n.v sarl sas sa srl spa s.r.l sl s.l sp oy ab aps gmbh&co "
    "unternehmergesellschaft haftungsbeschränkt company the our this die der das und siehe oben"
).split()

# --- images

IMG_TAG = r"<img\b[^>]*>"
ATTRIBUTE = r"""([a-zA-Z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s">]+))"""
MODERN_IMAGES = (".webp", ".avif")
RASTER_IMAGES = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tif", ".tiff")
CHROME_IMAGE = (
    r"logo|icon|sprite|badge|payment|visa|mastercard|paypal|klarna|flag|avatar|placeholder|spinner|loader|pixel|1x1|blank|spacer|arrow|star|rating|social"
    r"|facebook|instagram|whatsapp|cookie|banner-?ad"
)

# --- scores

PLATFORM_POINTS = {"Shopify": 35, "WooCommerce": 35, "BigCommerce": 22, "Magento": 22, "PrestaShop": 22, "OpenCart": 22, "Wix": 10, "Squarespace": 10}
UNKNOWN_PLATFORM_POINTS = 10
BASE_POINTS, CART_POINTS, SCHEMA_POINTS, MX_POINTS, FAST_POINTS, ROLE_POINTS, FAST_MS = 5, 20, 5, 15, 5, -5, 2000
#: (least year, points), newest first.
RECENCY_POINTS = ((2024, 15), (2022, 12), (2020, 6))
MIN_YEAR, MIN_SCORE, MAX_ATTEMPTS, MIN_IMAGES = 2020, 55, 3, 20
