"""A small labelled table of URLs: invented sites of common kinds, wanted and unwanted.

No host stands in any table that the filter judges. Sites of both classes use the same endings, the
same leading labels and words in common (`farm`, `track`, `free`, `adult`), so that what a site is
about decides.
"""

from __future__ import annotations

ALLOWED = (
    "harbour-gazette.org/news/local/2031", "www.valleyobserver.net/politics/council-vote", "morningtribune.info/world/88",
    "weather-station.net/forecast/weekend", "www.northern-lights-journal.org/issue/14/article/3", "citylibrary.org/catalogue/search",
    "blog.motherandbaker.net/sourdough-starter", "recipes.kitchentable.org/soups/lentil", "www.gardenhelper.net/roses/pruning",
    "greenfarm-dairy.org/visit", "farmersmarket.info/stalls", "www.organic-farming.net/soil/compost", "track-and-field.org/results/2030",
    "railway-tracks-museum.net/exhibits", "parcel-tracking.org/help", "adult-education.net/evening-classes", "www.adultliteracy.org/tutors",
    "free-software-manual.org/install", "freedom-of-press.net/reports/3", "www.school-district9.org/calendar", "maths-lessons.net/fractions/2",
    "university-press.org/books/history", "docs.opencompiler.org/guide/setup", "wiki.sailingclub.net/knots", "forum.cyclists.info/thread/4471",
    "www.theatre-royal.org/tickets/season", "museumofglass.net/opening-hours", "art-gallery.info/painters/modern", "orchestra.net/concerts/spring",
    "blog.windingriver.org/2029/autumn", "m.thelanternpost.net/culture/11", "www.thornton-heritage.org/archive", "another-bookshop.net/fiction",
    "hospital-trust.org/departments/heart", "www.dentist-advice.info/children", "pharmacist-association.net/training", "nursing-journal.org/abstract/71",
    "animal-shelter.net/adopt/dogs", "www.birdwatch.org/sightings", "mountain-huts.info/routes/4", "hiking-trails.net/map/west",
    "travel-notes.org/islands/ferry", "www.trainstation.net/departures", "airport-guide.info/parking", "hotel-lakeside.org/rooms",
    "council.northshire.net/planning/notices", "www.taxoffice-help.org/forms/12", "parliament-record.net/debates", "court-library.org/cases/1998",
    "science-daily-notes.org/physics/9", "astronomy.net/telescopes/build", "www.chemistrylab.info/safety", "geology-survey.org/maps",
    "statistics-office.net/tables/population", "open-data.org/datasets/rainfall", "code-review.net/patterns", "www.database-tutorial.org/joins",
    "bank-history.net/museum", "credit-union.org/branches", "insurance-explained.info/house", "pension-advice.net/questions",
    "chess-club.org/openings", "www.boardgames.net/reviews/5", "football-league.info/fixtures", "swimming-pool.org/lessons",
    "knitting-patterns.net/scarf", "woodwork.org/joints/dovetail", "photography-basics.net/light", "film-society.info/programme",
    "www.gemeinde-nachrichten.net/rathaus", "bibliothek-online.org/ausleihe", "zeitung-am-morgen.info/wirtschaft", "noticias-del-valle.org/deportes",
    "cocina-de-casa.net/recetas/sopa", "journal-du-matin.org/culture", "mairie-de-rive.net/horaires", "histoire-locale.info/chapitre/2",
    "translation-institute.org/nations", "international-station.net/mission", "thethirdpage.org/essays", "tionesta-river.net/fishing",
)

BLOCKED = (
    "bestpillshop.org/order-now", "www.discount-pills.net/no-prescription", "viagra-online-store.info/buy", "cheapmeds24.org/pharmacy/sale",
    "pills-without-doctor.net/checkout", "weightloss-miracle-pill.info/offer", "royal-casino-games.org/slots", "www.casino-jackpot.net/bonus",
    "online-casino-vip.info/register", "megacasino.org/free-spins", "slots-winner.net/play", "poker-bonus-cash.org/deposit",
    "www.pokerking.info/tables/win", "roulette-cash.net/win-big", "bets-and-odds.org/signup", "free-betting-tips.net/bet",
    "sports-bet-bonus.info/bets", "livebets.org/odds/today", "bingo-win-cash.net/play", "lottery-winners-claim.org/prize",
    "you-win-a-phone.info/claim/now", "free-gift-cards.net/win", "winbigtoday.org/casino", "prize-notification.info/winner",
    "adult-webcams.org/live", "www.adult-dating-tonight.net/join", "adultvideos.info/watch/12", "hot-girls-cams.org/chat",
    "xxx-movies.net/free", "sexy-singles.info/meet", "porn-hd-tube.org/videos/3", "xxxadult.net/gallery",
    "nude-cams-free.info/live", "escort-service-city.org/book", "milf-dates.net/join", "adult-toys-xxx.info/sale",
    "payday-cash-loans.org/apply", "instant-loan-no-credit.net/apply-now", "www.fastloans24.info/approve", "debt-gone-quick.org/offer",
    "crypto-doubler.net/invest", "bitcoin-profit-bot.info/start", "forex-rich-secret.org/signup", "get-rich-fast.net/secret",
    "make-money-from-home.info/start", "earn-cash-surveys.org/join", "replica-watches-outlet.net/rolex", "www.cheap-handbags.info/replica",
    "cheap-sneakers-outlet.org/sale", "designer-replica-bags.net/buy", "cheapcigarettes.info/order", "cheap-essay-writers.org/order",
    "torrent-movies-free.net/download", "crack-keygen-serials.info/download", "warez-full-crack.org/get", "free-mp3-rips.net/download",
    "www.softwarecrack.info/keygen", "cracked-games.org/torrent", "ads-network-popunder.net/click", "popup-ads.info/serve/7",
    "adserver-clicks.org/track/pixel", "www.tracker-pixels.net/collect", "click-tracker-ads.info/redirect", "banner-ads-exchange.org/ad/3",
    "adtrack-stats.net/pixel/1", "ads-redirect.info/out", "backlinks-spam.org/buy-links", "seo-link-farms.net/submit",
    "www.spam-links-blast.info/post", "comment-spammer.org/tool", "spamhost-farm.net/pages/8", "link-farm-directory.info/add",
    "buy-followers-likes.org/instagram", "cheap-likes.net/buy", "bulk-email-spam.info/lists", "spam-bulk-mailer.org/send",
    "phishing-login-verify.net/account", "secure-account-update.info/verify/login", "free-iphone-winner.org/claim", "miracle-cure-secret.net/order",
    "hair-loss-pills.info/buy", "cbd-gummies-cheap.org/sale", "steroid-shop-online.net/buy", "testosterone-boost.info/order-now",
    "psychic-hotline-free.org/call", "sugar-daddy-dates.net/signup", "hookup-tonight.info/join", "hacked-accounts-shop.org/buy",
)
