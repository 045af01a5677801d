"""Terms of unwanted addresses by category, with weights.

The categories are those that public blocklists part addresses into. A term of
weight 2 decides alone; terms of weight 1 are met in clean addresses too, so two
distinct ones are needed, of any category.
"""

TERMS = {
    "adult": {
        "adult": 2, "camgirl": 2, "camgirls": 2, "escort": 2, "escorts": 2, "hentai": 2, "milf": 2, "nsfw": 2, "porn": 2,
        "porno": 2, "pornography": 2, "sexcam": 2, "sexcams": 2, "xxx": 2,
        "cam": 1, "cams": 1, "dating": 1, "erotic": 1, "fetish": 1, "hookup": 1, "naked": 1, "nude": 1, "nudes": 1, "sex": 1,
        "sexy": 1,
    },
    "gambling": {
        "baccarat": 2, "betting": 2, "bookmaker": 2, "bookmakers": 2, "casino": 2, "gambling": 2, "slot-machine": 2,
        "slot-machines": 2, "sportsbook": 2, "sportsbooks": 2,
        "bet": 1, "bets": 1, "bingo": 1, "blackjack": 1, "bonus": 1, "free": 1, "jackpot": 1, "jackpots": 1, "lottery": 1,
        "lotto": 1, "poker": 1, "roulette": 1, "slots": 1, "wager": 1, "win": 1,
    },
    "pharmacy": {
        "canadian-pharmacy": 2, "cheap-meds": 2, "cialis": 2, "kamagra": 2, "levitra": 2, "no-prescription": 2,
        "online-pharmacy": 2, "viagra": 2,
        "cheap": 1, "meds": 1, "pharmacy": 1, "phentermine": 1, "pills": 1, "rx": 1, "sildenafil": 1, "steroids": 1,
        "tadalafil": 1, "tramadol": 1, "xanax": 1,
    },
    "spam and link farms": {
        "article-farm": 2, "buy-backlinks": 2, "click-farm": 2, "content-farm": 2, "doorway-pages": 2, "link-exchange": 2,
        "link-farm": 2, "link-farms": 2, "linkfarm": 2, "linkfarms": 2, "spam": 2, "splog": 2, "splogs": 2,
        "backlink": 1, "backlinks": 1, "clickbait": 1, "doorway": 1, "seo": 1, "spammer": 1, "spammy": 1,
    },
    "ads and tracking": {
        "ad-network": 2, "ad-server": 2, "adclick": 2, "ads": 2, "adserver": 2, "adservers": 2, "adtrack": 2, "adtracker": 2,
        "adware": 2, "click-tracker": 2, "click-tracking": 2, "doubleclick": 2, "popunder": 2, "popunders": 2,
        "tracking-pixel": 2, "web-beacon": 2,
        "advert": 1, "adverts": 1, "affiliate": 1, "affiliates": 1, "banners": 1, "popup": 1, "popups": 1, "sponsored": 1,
        "tracker": 1, "trackers": 1, "tracking": 1,
    },
    "fraud and stolen goods": {
        "keygen": 2, "keygens": 2, "payday-loan": 2, "payday-loans": 2, "phishing": 2, "warez": 2,
        "crack": 1, "cracked": 1, "loan": 1, "loans": 1, "nulled": 1, "payday": 1, "torrent": 1, "torrents": 1,
    },
}
