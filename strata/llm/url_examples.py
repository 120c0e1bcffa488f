"""A small labelled URL table: invented URLs to block (gambling, adult, pills, ads, spam) and to
allow.  Both classes have paths and parameters of the same shapes, so that names decide."""

BLOCKED = (
    "http://www.casino-royal.example.com/en/100",
    "https://blog.online-casino.example.net/en/1467/",
    "http://casino-win-big.example.org/de/2834.html",
    "https://m.mega-casino.example.com/de/4201?page=2&ref=x",
    "http://vip-casino-club.example.net/fr/5568#top",
    "https://www.free-bets-today.example.com/fr/6935?utm_source=feed",
    "http://blog.best-bets.example.net/es/8302",
    "https://sport-bets.example.org/es/669/",
    "http://m.bets-bonus.example.com/en/2036.html",
    "https://freebets.example.net/en/3403?page=2&ref=x",
    "http://www.poker-slots.example.com/de/4770#top",
    "https://blog.slot-machine-win.example.net/de/6137?utm_source=feed",
    "http://jackpot-win.example.org/fr/7504",
    "https://m.lucky-win.example.com/fr/8871/",
    "http://roulette-bonus.example.net/es/1238.html",
    "https://www.adult-chat.example.com/es/2605?page=2&ref=x",
    "http://blog.adult-video-x.example.net/en/3972#top",
    "https://x-adult.example.org/en/5339?utm_source=feed",
    "http://m.adult-dating.example.com/de/6706",
    "https://xxx-cams.example.net/de/8073/",
    "http://www.cheap-meds.example.com/fr/440.html",
    "https://blog.buy-pills-online.example.net/fr/1807?page=2&ref=x",
    "http://cheap-pills-shop.example.org/es/3174#top",
    "https://m.discount-pills.example.com/es/4541?utm_source=feed",
    "http://pills-no-prescription.example.net/en/5908",
    "https://www.cheap-watches.example.com/en/7275/",
    "http://blog.cheap-replica-bags.example.net/de/8642.html",
    "https://cheap-viagra.example.org/de/1009?page=2&ref=x",
    "http://m.diet-pills-fast.example.com/fr/2376#top",
    "https://cheap-loans.example.net/fr/3743?utm_source=feed",
    "http://www.spam-site.example.com/es/5110",
    "https://blog.link-farm.example.net/es/6477/",
    "http://spamfarm.example.org/en/7844.html",
    "https://m.content-farm-spam.example.com/en/211?page=2&ref=x",
    "http://spam-links.example.net/de/1578#top",
    "https://www.ads-server.example.com/de/2945?utm_source=feed",
    "http://blog.adserv-track.example.net/fr/4312",
    "https://ads-click-track.example.org/fr/5679/",
    "http://m.tracking-pixel.example.com/es/7046.html",
    "https://track-ads.example.net/es/8413?page=2&ref=x",
    "http://www.click-ads.example.com/en/780#top",
    "https://blog.popup-ads.example.net/en/2147?utm_source=feed",
    "http://banner-ads.example.org/de/3514",
    "https://m.ad-tracker.example.com/de/4881/",
    "http://clicktrack.example.net/fr/6248.html",
    "https://www.win-a-phone.example.com/fr/7615?page=2&ref=x",
    "http://blog.free-prize-win.example.net/es/8982#top",
    "https://free-money.example.org/es/1349?utm_source=feed",
    "http://m.get-rich-fast.example.com/en/2716",
    "https://free-gift-cards.example.net/en/4083/",
    "http://www.crypto-double.example.com/de/5450.html",
    "https://blog.payday-cash-now.example.net/de/6817?page=2&ref=x",
    "http://work-from-home-cash.example.org/fr/8184#top",
    "https://m.malware-download.example.com/fr/551?utm_source=feed",
    "http://warez-crack.example.net/es/1918",
    "https://www.torrent-crack-keygen.example.com/es/3285/",
    "http://blog.free-followers.example.net/en/4652.html",
    "https://buy-likes.example.org/en/6019?page=2&ref=x",
    "http://m.seo-backlinks-farm.example.com/de/7386#top",
    "https://hot-singles.example.net/de/8753?utm_source=feed",
    "http://www.casino-bonus.example.com/fr/1120",
    "https://blog.grand-casino.example.net/fr/2487/",
    "http://casino-slots.example.org/es/3854.html",
    "https://m.live-poker.example.com/es/5221?page=2&ref=x",
    "http://poker-bonus.example.net/en/6588#top",
    "https://www.bets-live.example.org/en/7955?utm_source=feed",
    "http://blog.win-bets.example.com/de/322",
    "https://betting-odds.example.net/de/1689/",
    "http://m.lottery-jackpot.example.org/fr/3056.html",
    "https://slots-free-spins.example.com/fr/4423?page=2&ref=x",
    "http://www.adult-cams.example.net/es/5790#top",
    "https://blog.adult-singles.example.org/es/7157?utm_source=feed",
    "http://xxx-video.example.com/en/8524",
    "https://m.sex-dating.example.net/en/891/",
    "http://singles-chat.example.org/de/2258.html",
    "https://www.pills-cheap.example.com/de/3625?page=2&ref=x",
    "http://blog.viagra-pills.example.net/fr/4992#top",
    "https://online-meds-cheap.example.org/fr/6359?utm_source=feed",
    "http://m.weight-loss-pills.example.com/es/7726",
    "https://cheap-tickets-now.example.net/es/9093/",
    "http://www.ads-network.example.org/en/1460.html",
    "https://blog.ads-banner.example.com/en/2827?page=2&ref=x",
    "http://track-click.example.net/de/4194#top",
    "https://m.pixel-ads.example.org/de/5561?utm_source=feed",
    "http://adserver-pop.example.com/fr/6928",
    "https://www.spam-blog.example.net/fr/8295/",
    "http://blog.farm-spam-links.example.org/es/662.html",
    "https://link-spam.example.com/es/2029?page=2&ref=x",
    "http://m.seo-farm.example.net/en/3396#top",
    "https://backlinks-cheap.example.org/en/4763?utm_source=feed",
    "http://www.fast-loans.example.com/de/6130",
    "https://blog.payday-loans.example.net/de/7497/",
    "http://cash-loans-now.example.org/fr/8864.html",
    "https://m.quick-cash.example.com/fr/1231?page=2&ref=x",
    "http://win-free-cash.example.net/es/2598#top",
    "https://www.crack-download.example.org/es/3965?utm_source=feed",
)

ALLOWED = (
    "http://m.daily-herald.example.com/en/1011",
    "https://city-news.example.net/en/2378/",
    "http://www.morning-post.example.org/de/3745.html",
    "https://blog.science-weekly.example.com/de/5112?page=2&ref=x",
    "http://weather-report.example.net/fr/6479#top",
    "https://m.encyclopedia.example.com/fr/7846?utm_source=feed",
    "http://open-library.example.net/es/213",
    "https://www.history-museum.example.org/es/1580/",
    "http://blog.national-archive.example.com/en/2947.html",
    "https://art-gallery.example.net/en/4314?page=2&ref=x",
    "http://m.university.example.com/de/5681#top",
    "https://physics-department.example.net/de/7048?utm_source=feed",
    "http://www.school-board.example.org/fr/8415",
    "https://blog.research-institute.example.com/fr/782/",
    "http://math-lectures.example.net/es/2149.html",
    "https://m.garden-notes.example.com/es/3516?page=2&ref=x",
    "http://kitchen-recipes.example.net/en/4883#top",
    "https://www.mountain-trails.example.org/en/6250?utm_source=feed",
    "http://blog.river-fishing.example.com/de/7617",
    "https://bird-watching.example.net/de/8984/",
    "http://m.python-docs.example.com/fr/1351.html",
    "https://linux-handbook.example.net/fr/2718?page=2&ref=x",
    "http://www.compiler-notes.example.org/es/4085#top",
    "https://blog.database-journal.example.com/es/5452?utm_source=feed",
    "http://network-guide.example.net/en/6819",
    "https://m.thering.example.com/en/8186/",
    "http://thestand.example.net/de/553.html",
    "https://www.thornton.example.org/de/1920?page=2&ref=x",
    "http://blog.therapy-centre.example.com/fr/3287#top",
    "https://thatcher.example.net/fr/4654?utm_source=feed",
    "http://m.station.example.com/es/6021",
    "https://notation-music.example.net/es/7388/",
    "http://www.attention-span.example.org/en/8755.html",
    "https://blog.nation-review.example.com/en/1122?page=2&ref=x",
    "http://tension-bridge.example.net/de/2489#top",
    "https://m.ableton.example.com/de/3856?utm_source=feed",
    "http://noble-house.example.net/fr/5223",
    "https://www.stable-horses.example.org/fr/6590/",
    "http://blog.table-tennis.example.com/es/7957.html",
    "https://bible-study.example.net/es/324?page=2&ref=x",
    "http://m.leader-times.example.com/en/1691#top",
    "https://reader-forum.example.net/en/3058?utm_source=feed",
    "http://www.theatre-group.example.org/de/4425",
    "https://blog.weather-north.example.com/de/5792/",
    "http://earth-watch.example.net/fr/7159.html",
    "https://m.heritage.example.com/fr/8526?page=2&ref=x",
    "http://shelter-animals.example.net/es/893#top",
    "https://www.northern-lights.example.org/es/2260?utm_source=feed",
    "http://blog.southern-rail.example.com/en/3627",
    "https://eastern-coast.example.net/en/4994/",
    "http://m.anderson.example.com/de/6361.html",
    "https://henderson-family.example.net/de/7728?page=2&ref=x",
    "http://www.thomas-writer.example.org/fr/9095#top",
    "https://blog.edison-lab.example.com/fr/1462?utm_source=feed",
    "http://winter-sports.example.net/es/2829",
    "https://m.tower-bridge.example.com/es/4196/",
    "http://window-repair.example.net/en/5563.html",
    "https://www.address-book.example.org/en/6930?page=2&ref=x",
    "http://blog.roads-and-maps.example.com/de/8297#top",
    "https://shadows-theatre.example.net/de/664?utm_source=feed",
    "http://m.evening-news.example.com/fr/2031",
    "https://herald-tribune.example.net/fr/3398/",
    "http://www.local-news.example.org/es/4765.html",
    "https://blog.news-archive.example.com/es/6132?page=2&ref=x",
    "http://times-weekly.example.net/en/7499#top",
    "https://m.public-library.example.org/en/8866?utm_source=feed",
    "http://maritime-museum.example.com/de/1233",
    "https://www.gallery-modern.example.net/de/2600/",
    "http://blog.history-notes.example.org/fr/3967.html",
    "https://archive-maps.example.com/fr/5334?page=2&ref=x",
    "http://m.college-lectures.example.net/es/6701#top",
    "https://research-lab.example.org/es/8068?utm_source=feed",
    "http://www.chemistry-institute.example.com/en/435",
    "https://blog.school-library.example.net/en/1802/",
    "http://mathematics-club.example.org/de/3169.html",
    "https://m.bread-recipes.example.com/de/4536?page=2&ref=x",
    "http://garden-flowers.example.net/fr/5903#top",
    "https://www.forest-trails.example.org/fr/7270?utm_source=feed",
    "http://blog.bird-guide.example.com/es/8637",
    "https://river-maps.example.net/es/1004/",
    "http://m.linux-guide.example.org/en/2371.html",
    "https://compiler-handbook.example.com/en/3738?page=2&ref=x",
    "http://www.code-review-notes.example.net/de/5105#top",
    "https://blog.network-docs.example.org/de/6472?utm_source=feed",
    "http://database-guide.example.com/fr/7839",
    "https://m.thornhill.example.net/fr/206/",
    "http://theatre-north.example.org/es/1573.html",
    "https://www.stationmaster.example.com/es/2940?page=2&ref=x",
    "http://blog.nations-forum.example.net/en/4307#top",
    "https://theology.example.org/en/5674?utm_source=feed",
    "http://m.weather-station.example.com/de/7041",
    "https://table-makers.example.net/de/8408/",
    "http://www.bridge-club.example.org/fr/775.html",
    "https://blog.tower-clocks.example.com/fr/2142?page=2&ref=x",
    "http://shelter-north.example.net/es/3509#top",
    "https://m.writer-letters.example.org/es/4876?utm_source=feed",
)
