"""A small labelled URL table: written and labelled by hand, one url at a time, for training and held-out tests."""

# Urls to block: gambling, betting, pills, adult, advert trackers, link farms, fraud, pirated software.
BLOCK = """
http://www.casino-royal-win.com/play/bonus
https://blog.lucky-casino.example.net/fr/2336.html
http://m.casino-nights.net/en/jackpot
https://casino-win-big.example.net/es/4490?utm_source=feed
http://royal-slots-casino.biz/register
https://blog.vegas-slots-jackpot.example.com/en/2380.html
http://m.roulette-spin.example.com/fr/3444
https://blackjack-vip-room.example.com/en/8413?utm_source=feed
http://megajackpot-slots.info/free-spins
https://m.win-jackpot-now.example.org/en/304
http://free-bets-today.com/tips
https://best-bets.example.com/en/6943.html
http://www.sure-bets.info/football/tips
https://bets-bonus.example.org/de/8839#top
http://betting-tips-vip.com/fixed-matches
https://fixed-odds-betting.example.com/en/9095/
http://m.sportbets-live.com/odds
https://free-bets-club.example.com/es/9952.html
http://online-poker-bonus.com/download
https://poker-room-win.example.org/es/9982.html
http://lottery-winner-claim.info/prize
https://mega-lottery-online.example.com/en/3143?utm_source=feed
http://instant-lottery-win.biz/play
https://m.you-won-prize.example.net/fr/6317?utm_source=feed
http://cheap-pills-online.biz/order
https://m.discount-pills.example.com/fr/3849#top
http://pills-no-prescription.com/order/cheap
https://m.cheap-meds-rx.example.net/de/461.html
http://online-pharma-discount.net/pills
https://blog.pharma-cheap-rx.example.com/en/3639?utm_source=feed
http://viagra-deals.biz/buy-cheap
https://blog.generic-viagra-shop.example.com/es/3348?page=2&ref=x
http://diet-pills-miracle.info/buy
https://weightloss-miracle-pills.example.com/de/1277?utm_source=feed
http://cheap-cialis-meds.net/order
https://m.xxx-cams-live.example.com/es/4530.html
http://www.free-xxx-videos.net/hot
https://m.hot-porn-tube.example.com/es/6034/
http://porn-free-clips.info/xxx
https://m.adult-cams-chat.example.net/es/7803?utm_source=feed
http://hot-escort-girls.net/tonight
https://blog.escort-vip-city.example.com/de/7614?page=2&ref=x
http://singles-hookup-tonight.com/join
https://m.nude-webcams-free.example.com/de/3602?page=2&ref=x
http://sexy-dating-now.biz/signup
https://ads-track.example.net/fr/2941/
http://m.ads-tracker.com/pixel
https://adserver-click.example.com/de/1901#top
http://adserver.example.com/en/5283?utm_source=feed
https://m.click-ads-network.example.com/de/8638?page=2&ref=x
http://popads-serve.info/popunder
https://blog.track-pixel-ads.example.org/fr/4303?utm_source=feed
http://banner-ads-exchange.biz/click
https://blog.ad-click-tracker.example.com/es/4773?page=2&ref=x
http://clicktrack-affiliate.net/redirect/offer
https://spam-farm.example.net/fr/8440?utm_source=feed
http://www.spam-links-farm.net/page
https://blog.link-farm-seo.example.com/fr/8535#top
http://seo-spam-links.com/cheap
https://buy-backlinks-cheap.example.com/en/2158?page=2&ref=x
http://email-spam-blaster.info/download
https://m.article-spinner-farm.example.org/de/3952/
http://payday-loan-fast.com/apply
https://blog.instant-payday-cash.example.org/en/9173?page=2&ref=x
http://no-credit-check-loans.info/apply-now
https://quick-cash-payday.example.net/en/6842.html
http://account-verify-login.info/secure/update
https://paypal-account-secure-verify.example.com/es/3260?page=2&ref=x
http://bank-login-update-verify.net/secure
https://crypto-doubler-invest.example.net/fr/6308?page=2&ref=x
http://get-rich-quick-now.com/join
https://www.easy-money-profit.example.com/de/506
http://free-gift-card-winner.net/claim
https://claim-free-iphone-gift.example.org/de/6217
http://replica-watches-cheap.biz/sale
https://m.fake-replica-bags.example.com/fr/4435?utm_source=feed
http://warez-cracks-keygen.com/download
https://full-warez-downloads.example.org/en/3472?page=2&ref=x
http://keygen-serial-crack.info/free
https://torrent-crack-software.example.org/de/1175.html
https://cheap-rx-pills.example.com/de/520.html
http://www.cheap-cigarettes-order.example.com/es/77
https://m.spam-bots.example.com/en/1883#top
http://linkfarm-directory.example.com/fr/940/
https://www.pills-cheap-shop.example.com/es/3350.html
http://content-farm-spam.example.com/de/28?page=2&ref=x
https://winbig-casinos.example.com/fr/601
http://m.adtrack-pixel.example.com/es/5127.html
https://www.grand-casino-spin.example.org/en/605
http://www.casino-bonus-club.example.org/de/41.html
https://www.xxx-video-hub.example.org/en/9231#top
http://www.fast-payday-money.example.org/es/17/
https://www.warez-serials.example.org/en/388?page=2&ref=x
http://www.lucky-bets-win.example.org/fr/2750
""".split()

# Urls to allow: news, learning, science, museums, shops, towns, private pages, documentation, invented names.
ALLOW = """
https://m.riverside-museum.example.net/en/5447/
http://news.morning-herald.com/world/2024/05/article
https://docs.openlibrary-tools.org/guide/install.html
http://university-north.example.net/fr/2944?utm_source=feed
https://blog.gardenersnotebook.net/spring/tomatoes
http://cooking-with-anna.com/recipes/soup
https://blog.encyclopedia-free.example.net/de/487/
http://www.townhall-brookfield.gov/services/water
https://school-district-12.org/calendar
http://blog.weather-station.example.org/es/2938
https://www.bookshop-corner.com/novels/new
http://bicycle-repair-guide.org/chain
https://hiking-trails.example.org/maps/alps
http://www.national-parks.gov/wildlife/birds
https://chess-club-town.net/games/archive
http://photography-basics.example.net/es/3905#top
https://history-of-bridges.org/roman
http://www.hospital-stmary.org/patients/visiting
https://choir-evensong.example.com/en/5903#top
http://train-timetable.com/lines/north
https://science-daily-letters.org/2023/geology
http://m.football-association.example.com/es/4850/
https://www.violin-makers.com/workshop
http://local-library.org/opening-hours
https://python-notes.example.com/fr/2659?page=2&ref=x
http://www.city-theatre.com/programme
https://astronomy-picture.org/nebula
http://blog.economics-review.example.org/de/7539.html
https://www.farmers-market.org/stalls
http://language-school.com/courses/german
https://travelling-light.example.com/es/8814?utm_source=feed
http://www.botanical-garden.org/plants/ferns
https://mathematics-forum.net/algebra/groups
http://blog.parish-council.example.org/en/1741?page=2&ref=x
https://www.furniture-makers.com/oak/tables
http://radio-archive.org/programmes/1974
https://open-source-maps.example.net/fr/278#top
http://www.swimming-pool.org/lessons
https://knitting-patterns.com/jumper
http://blog.engineering-handbook.example.net/fr/2791/
https://www.art-gallery.org/exhibitions/current
http://poetry-magazine.com/issues/winter
https://blog.kids-science.example.com/de/4126.html
http://www.orchestra-town.net/season
https://philosophy-notes.com/plato
http://fishing-rivers.example.org/fr/4679.html
https://www.bakery-lane.com/bread
http://m.newspaper-evening.net/local/council
https://software-manual.example.net/es/9948#top
http://www.antique-clocks.com/repair
https://medical-journal.org/volume/12/article
http://www.nursery-school.example.com/fr/533?utm_source=feed
https://www.sailing-club.org/races
http://geography-atlas.com/rivers/danube
https://law-library.example.org/es/6944?page=2&ref=x
http://www.film-archive.net/silent
https://mountain-weather.org/snow
http://m.teachers-resource.example.net/es/6220.html
https://www.bridge-engineers.org/papers
http://coffee-roasters.net/beans
https://tolmira.example.com/en/4021
http://www.velunor.example.com/de/118
https://m.harestin.example.net/fr/5520?page=2
http://blog.onthera.example.com/en/731#top
https://quendal.example.org/es/9034.html
http://www.sormeth.example.org/en/2266/
https://brisantel.example.com/fr/310?utm_source=feed
http://m.thelandor.example.com/en/8812
https://blog.ensural.example.net/de/64/
http://wintheron.example.org/en/4471
https://www.pelorin.example.com/es/5098?page=2&ref=x
http://indsteren.example.net/en/1203#top
https://m.aldwhen.example.com/de/6677.html
http://blog.retionsh.example.com/fr/2381
https://www.oneshter.example.net/en/990/
http://hathering.example.com/en/3745?utm_source=feed
https://thenst.example.org/fr/8120
http://www.edblyan.example.com/es/441.html
https://m.stourend.example.com/en/7302/
http://blog.erantio.example.com/de/5913#top
https://www.mentreau.example.com/fr/1450
http://ouellement.example.com/fr/6234?page=2
https://m.ciondero.example.com/es/3871
http://www.schheitung.example.com/de/2509/
https://blog.ndenstre.example.com/de/718.html
http://www.ersthona.example.com/en/9466
https://anthwhed.example.com/en/157?utm_source=feed
http://m.lytherin.example.com/en/8033#top
https://thathern.example.com/es/88.html
http://www.thalestin.example.net/en/2750
https://m.thishold.example.com/de/431.html
http://thothand.example.org/es/1905/
https://tionande.example.com/es/660#top
http://blog.thandrel.example.com/es/72.html
https://hatherlow.example.net/en/3391.html
http://m.thenethe.example.org/de/14/
https://ththoren.example.com/es/4510?page=2&ref=x
http://www.othithe.example.com/en/63.html
https://blog.thellyn.example.net/fr/2084
http://theathou.example.com/de/9310
""".split()
