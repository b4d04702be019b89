"""Texts written by hand, unlike any test table: news, narration, dialogue, figures, verses, instructions; and junk."""

PROSE = {
    "en": [
        "The city council voted on Tuesday to extend the tram line to the harbour, a project that has been debated for more than a decade. Construction is expected to begin next spring, officials said, although funding for the last two stations has not been approved yet.",
        "\"Have you seen my keys?\" she asked.\n\"On the shelf, under the newspaper,\" he said without looking up.\n\"They are not there any more.\"\n\"Then you must have left them in the car again.\"",
        "Sales rose by 12.5% to 48 million euros in 2023, while costs fell by 3%. In the first quarter of 2024 the company hired 220 people, 80 of them in its new plant near the border.",
        "When the night is long and the road is cold\nand the wind comes in from the sea\nI will keep the light by the window, love\nand wait till you come to me",
        "so yeah i was thinking that we could maybe go there on saturday because the weather is going to be good and then on sunday we just stay at home and watch that movie you told me about",
        "Bring the water to a boil, then add the salt and the pasta. Stir once, so that nothing sticks to the bottom. After nine minutes, taste a piece; it should be firm but not hard. Drain it, keep a cup of the water, and mix everything with the sauce.",
        "It rained. We waited. Nobody came. At six, the lights in the station went out, one by one, and a guard told us that the last train had left an hour ago.",
    ],
    "tl": [
        "Inaprubahan ng lungsod nitong Martes ang bagong ruta ng mga bus papunta sa pantalan. Ayon sa alkalde, magsisimula ang biyahe sa susunod na buwan, pero hindi pa tiyak kung magkano ang pamasahe para sa mga estudyante.",
        "\"Nakita mo ba ang susi ko?\" tanong niya.\n\"Nasa mesa, sa ilalim ng diyaryo,\" sagot ng kuya ko.\n\"Wala na rito, eh.\"\n\"Baka naiwan mo na naman sa kotse.\"",
        "Tumaas ng 12.5% ang benta ng kumpanya noong 2023, at umabot ito sa 48 milyong piso. Sa unang tatlong buwan ng taon, kumuha sila ng 220 na bagong empleyado para sa pabrika sa Laguna.",
        "Sa gabing malamig at mahaba ang daan\nako ay maghihintay sa may bintana\ndala ang ilaw na hindi mamamatay\nhanggang sa ikaw ay bumalik, sinta",
        "Pakuluan muna ang tubig, saka ilagay ang asin at ang karne. Haluin nang dahan-dahan para hindi dumikit sa kaldero. Pagkalipas ng isang oras, idagdag ang gulay at tikman ang sabaw.",
        "noong bata pa kami lagi kaming pumupunta sa ilog tuwing sabado kasi mainit sa bahay at wala namang kuryente kaya doon na rin kami kumakain ng tanghalian kasama ang mga pinsan ko",
    ],
    "id": [
        "Pemerintah kota menyetujui pembangunan jalur trem baru menuju pelabuhan pada hari Selasa. Menurut wali kota, pekerjaan akan dimulai tahun depan, tetapi dana untuk dua stasiun terakhir belum tersedia.",
        "\"Kamu lihat kunci saya tidak?\" tanya ibu.\n\"Di rak, di bawah koran,\" jawab ayah.\n\"Sudah tidak ada di sini.\"\n\"Mungkin ketinggalan di mobil lagi.\"",
        "Penjualan naik 12,5% menjadi 48 miliar rupiah pada 2023, sedangkan biaya turun 3%. Pada triwulan pertama perusahaan itu menerima 220 pegawai baru untuk pabrik di Bekasi.",
        "Di malam yang dingin dan panjang\nangin datang dari laut\naku menunggu di tepi jendela\nsampai kamu pulang lagi",
        "Didihkan air, lalu masukkan garam dan mi. Aduk sekali supaya tidak lengket. Setelah tiga menit, angkat dan tiriskan, kemudian campur dengan bumbu yang sudah ditumis.",
        "waktu kecil kami sering pergi ke sungai karena di rumah panas sekali dan tidak ada listrik jadi kami makan siang di sana bersama sepupu dan pulang kalau hari sudah sore",
    ],
    "vi": [
        "Hội đồng thành phố hôm thứ Ba đã thông qua kế hoạch kéo dài tuyến xe điện đến cảng. Theo thị trưởng, công trình sẽ bắt đầu vào mùa xuân năm sau, nhưng kinh phí cho hai ga cuối vẫn chưa có.",
        "\"Con có thấy chìa khóa của mẹ không?\" bà hỏi.\n\"Ở trên kệ, dưới tờ báo,\" cậu bé trả lời.\n\"Không còn ở đó nữa.\"\n\"Chắc mẹ lại để quên trong xe rồi.\"",
        "Doanh thu tăng 12,5% lên 48 tỉ đồng trong năm 2023, còn chi phí giảm 3%. Trong quý đầu, công ty đã tuyển thêm 220 người cho nhà máy mới ở gần biên giới.",
        "Đêm dài và con đường thì lạnh\ngió từ biển thổi vào trong nhà\nanh vẫn ngồi bên khung cửa sổ\nchờ em về khi mùa đã qua",
        "Đun sôi nước rồi cho muối và mì vào. Khuấy một lần để mì không dính vào đáy nồi. Sau chín phút thì vớt ra, để ráo, và trộn đều với nước sốt đã nấu.",
        "hồi nhỏ chúng tôi hay ra sông vì ở nhà nóng lắm mà lại không có điện nên cả nhà mang cơm ra đó ăn trưa với mấy người anh họ rồi chiều mới về",
    ],
    "th": [
        "สภาเมืองลงมติเมื่อวันอังคารให้ขยายเส้นทางรถรางไปถึงท่าเรือ โครงการนี้ถกเถียงกันมากว่าสิบปีแล้ว นายกเทศมนตรีบอกว่าการก่อสร้างจะเริ่มในปีหน้า แต่ยังไม่มีเงินสำหรับสองสถานีสุดท้าย",
        "\"เห็นกุญแจของแม่ไหม\" แม่ถาม\n\"อยู่บนชั้น ใต้หนังสือพิมพ์\" พ่อตอบ\n\"ไม่มีแล้ว หาไม่เจอ\"\n\"คงลืมไว้ในรถอีกแล้วละสิ\"",
        "ยอดขายเพิ่มขึ้น 12.5% เป็น 48 ล้านบาทในปี 2566 ส่วนค่าใช้จ่ายลดลง 3% ในไตรมาสแรกบริษัทรับพนักงานใหม่ 220 คนสำหรับโรงงานที่อยู่ใกล้ชายแดน",
        "คืนนี้หนาวและทางยังอีกไกล\nลมพัดมาจากทะเล\nฉันจะจุดไฟไว้ข้างหน้าต่าง\nรอจนกว่าเธอจะกลับมา",
        "ต้มน้ำให้เดือดแล้วใส่เกลือกับเส้นลงไป คนหนึ่งครั้งเพื่อไม่ให้ติดก้นหม้อ เมื่อครบเก้านาทีให้ชิมดู ถ้าเส้นนุ่มแล้วก็เทน้ำออกและคลุกกับซอส",
    ],
    "zh": [
        "市议会周二投票决定把电车线路延长到港口，这个项目已经讨论了十多年。官员们说，工程预计明年春天开始，但是最后两个车站的资金还没有批准。",
        "“你看见我的钥匙了吗？”她问。\n“在架子上，报纸下面。”他头也不抬地说。\n“已经不在那里了。”\n“那你肯定又把它忘在车里了。”",
        "2023年销售额增长了12.5%，达到4800万元，而成本下降了3%。今年第一季度，公司招聘了220人，其中80人在边境附近的新工厂工作。",
        "夜很长，路也很冷\n风从海上吹来\n我会在窗边留一盏灯\n等你回到我身边",
        "先把水烧开，然后放入盐和面条。搅拌一次，这样就不会粘在锅底。九分钟以后尝一尝，面条应该有点硬但是不能太硬。最后把水倒掉，和酱汁一起拌匀。",
    ],
}

JUNK = [
    "Milk\nEggs\nBread\nTwo onions\nSoap\nBatteries\nLight bulbs\nStamps",
    "id,name,price,stock\n1,hammer,12.50,40\n2,saw,18.00,12\n3,pliers,9.90,77\n4,drill,89.00,5",
    "Home | About us | Products | Contact | Login | Cart (0) | English | Deutsch | Terms | Privacy",
    "def area(w, h):\n    return w * h\n\nfor i in range(10):\n    print(area(i, i + 1))",
    "2024-03-01 12:00:01 INFO server started port=8080\n2024-03-01 12:00:04 WARN slow query ms=2310\n2024-03-01 12:00:09 ERROR timeout id=77",
    "buy now buy now buy now buy now buy now buy now buy now buy now buy now buy now buy now buy now",
    "xqzv prtk wmbl ghrn dfkk zzpo wqer mnbv lkjh poiu ytre qwas zxcv",
    "!!! ??? *** ### $$$ %%% ^^^ &&& ((( ))) +++ === ~~~ <<< >>>",
    "1. apel\n2. jeruk\n3. mangga\n4. pisang\n5. anggur\n6. nanas\n7. pepaya",
    "苹果\n香蕉\n牛奶\n面包\n鸡蛋\n白菜\n土豆\n洗衣粉",
    "ข้าวสาร\nน้ำปลา\nไข่ไก่\nสบู่\nยาสีฟัน\nถ่านไฟฉาย\nผักกาด",
    "| Monday | 9:00 | Room 4 |\n| Tuesday | 10:30 | Room 2 |\n| Friday | 14:00 | Room 9 |",
    "4f 6e 65 20 6d 6f 72 65 00 00 1f 8b 08 00 a1 b2 c3 d4 e5 f6 07 18 29 3a 4b 5c 6d 7e 8f 90",
    "{\"user\": 17, \"tags\": [\"a\", \"b\"], \"score\": 0.93, \"ok\": true, \"next\": null, \"path\": \"/x/y/z\"}",
]
